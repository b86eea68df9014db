"""Column functions: time codes, scalars, text and keyword scores."""
