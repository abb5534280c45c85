"""Structured Streaming forms of ingestion and log health."""
