"""Streaming of textloom."""
