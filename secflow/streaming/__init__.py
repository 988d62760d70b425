"""Streaming jobs around the same operators that serve batch."""
