"""Plans of textloom."""
