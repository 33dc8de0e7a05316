"""Writers: delimited text, JSON Lines, Parquet, ORC, partitions, chunks, JDBC."""
