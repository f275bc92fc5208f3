"""Column expressions: text cleaning, tolerant typing, calendar periods, measures."""
