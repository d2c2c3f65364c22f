"""Structured Streaming: incremental landing and windowed event counts."""
