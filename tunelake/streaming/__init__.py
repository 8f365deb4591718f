"""Streams over growing folders, using the same operators as tables."""
