"""Structured Streaming: incoming points, counts, scoring, publishing."""
