"""File-stream ingestion."""
