"""Streaming forms of batch steps."""
