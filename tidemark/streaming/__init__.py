"""Structured Streaming ingest of landed files into keyed tables."""
