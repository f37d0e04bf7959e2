"""Structured Streaming jobs built on the keyed merge."""
