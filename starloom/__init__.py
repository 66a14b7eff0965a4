"""starloom — a Spark-native engine for building, checking and querying a
dimensional warehouse (staging → conformed dimensions → facts → aggregate →
quality checks → analyst queries)."""

__version__ = "0.1.0"
