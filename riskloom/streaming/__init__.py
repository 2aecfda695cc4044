"""Structured Streaming forms of the batch jobs (STR1-STR4)."""
