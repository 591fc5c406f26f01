"""Incremental form of the typed ingest."""
