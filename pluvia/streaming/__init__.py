"""Structured Streaming windows and jobs."""
