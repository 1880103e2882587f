"""Column expressions (tokenization, set similarity, renderings)."""
