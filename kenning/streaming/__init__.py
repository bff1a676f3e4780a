"""Structured Streaming entry points (ST-1)."""
