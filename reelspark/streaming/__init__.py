"""Structured Streaming wrappers around the incremental models."""
