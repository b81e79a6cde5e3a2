"""User-record ingestion on Spark: landed API responses to a keyed table."""
