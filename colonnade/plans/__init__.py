"""Composed jobs (C1-C13) and the query registry used by ``__spark_entry__``."""
