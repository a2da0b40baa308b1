"""Structured Streaming: ingestion and live state."""
