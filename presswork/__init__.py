"""News-article ingest, dedup, scoring and statistics as PySpark DataFrame functions."""
