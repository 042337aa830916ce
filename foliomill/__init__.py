"""Document analytics on Spark: relational, geometric and text operators over pages, lines and zones."""
