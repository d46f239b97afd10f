"""Streaming extraction and clustering."""
