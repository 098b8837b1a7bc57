"""Structured Streaming: ingest into bronze and live aggregates."""
