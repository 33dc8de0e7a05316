"""Training-data operators: ten ways to shape a corpus, and the queries over them."""
