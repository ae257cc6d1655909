"""Column -> Column expressions over article text and records."""
