"""Structured Streaming extension: metrics of moving points by cell."""
