"""A Spark-first engine for multimedia retrieval data."""
