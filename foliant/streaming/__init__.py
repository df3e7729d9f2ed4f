"""Structured Streaming forms of the page assembly and of line runs."""
