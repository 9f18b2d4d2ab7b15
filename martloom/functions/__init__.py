"""Column functions: text to typed values, calendar parts, money."""
