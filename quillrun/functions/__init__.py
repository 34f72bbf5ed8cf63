"""Column functions: text, arrays, log lines."""
