"""Column expressions: keys, hashes and names."""
