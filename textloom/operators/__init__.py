"""Operators of textloom."""
