"""Column-level building blocks: name resolution, casts, text similarity, hashing."""
