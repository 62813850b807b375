"""Loads that remember what they have read, on Structured Streaming."""
