"""Column expressions for one feed field each."""
