"""textloom: text-evidence analytics on the PySpark DataFrame, SQL and Structured Streaming APIs."""
