"""Reading: files in batch, files as a stream, tables by name and SQL."""
