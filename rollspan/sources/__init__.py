"""Reading, writing and incremental ingest."""
