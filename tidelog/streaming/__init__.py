"""Structured Streaming jobs: ingest into both stores, live state and health."""
