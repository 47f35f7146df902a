"""Column expressions: exact arithmetic, text, calendar, conditions."""
