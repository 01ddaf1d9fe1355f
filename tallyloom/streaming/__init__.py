"""Structured Streaming form of the clean-and-summarise steps."""
