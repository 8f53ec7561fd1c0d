"""Readers that turn landed data into typed rows."""
