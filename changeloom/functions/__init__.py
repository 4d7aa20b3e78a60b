"""Column-level building blocks: types, casts, keys and partition values."""
