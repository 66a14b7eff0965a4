"""Column expressions (no I/O, no UDFs)."""
