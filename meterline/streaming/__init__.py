"""Structured Streaming: micro-batch ingestion and event streams."""
