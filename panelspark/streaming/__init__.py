"""Incremental runs of the ingest jobs over a landing folder."""
