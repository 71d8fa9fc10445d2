"""Structured Streaming form of the current-state rebuild."""
