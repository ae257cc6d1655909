"""Structured Streaming versions of ingest, landing and scoring."""
