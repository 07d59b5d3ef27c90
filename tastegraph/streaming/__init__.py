"""Structured Streaming ingest, keyed node and edge tables."""
