"""Column functions: text forms, lenient numbers, JSON paths, dates, business days, tokens."""
