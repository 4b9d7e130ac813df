"""Tidemark: monthly lakehouse refreshes as plain PySpark DataFrame jobs."""
