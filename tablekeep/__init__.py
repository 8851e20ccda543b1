"""Incremental table jobs on PySpark: ingest, formats, upsert, upkeep and simple queries."""
