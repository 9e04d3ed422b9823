"""Column expressions: dates, calendar cut-offs, text and numbers."""
