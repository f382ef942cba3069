"""Column functions: dates, text, ratios."""
