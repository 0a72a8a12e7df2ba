"""Column expressions; all of them are built-in Catalyst functions."""
