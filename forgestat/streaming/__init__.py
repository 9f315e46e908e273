"""Structured Streaming form of the ingest (ST-01 ... ST-04)."""
