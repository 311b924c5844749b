"""Sources of textloom."""
