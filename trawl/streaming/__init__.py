"""Structured Streaming maintenance of a published index."""
