"""Column expressions: exact numbers, calendar arithmetic, ordering."""
