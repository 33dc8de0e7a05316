"""Jobs, scripts and the star-schema and streak pipelines."""
