"""Incremental ingest. All other work is batch."""
