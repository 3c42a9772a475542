"""Structured Streaming ingest: newly arrived documents (I1) and streaming
first-seen content dedup (I2)."""
