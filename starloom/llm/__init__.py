"""Operators of a training-data pipeline, and nothing that the rest of the library needs.

Nothing outside this folder imports it; ``queries.py`` holds the queries and
their SQL, which ``__spark_entry__.py`` adds when the folder is present.
"""
