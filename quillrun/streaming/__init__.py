"""Structured Streaming jobs over appended log lines."""
