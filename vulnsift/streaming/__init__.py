"""Structured Streaming: incremental, row-wise stages over landed files."""
