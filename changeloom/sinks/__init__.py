"""Writing: the keyed target table, rejects, audit tables and file layout."""
