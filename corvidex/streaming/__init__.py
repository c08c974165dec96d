"""Incremental ingest as a stream of files."""
