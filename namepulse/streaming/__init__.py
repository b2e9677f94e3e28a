"""Structured Streaming queries."""
