"""Structured Streaming over the live event feed."""
