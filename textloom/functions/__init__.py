"""Functions of textloom."""
