"""Streaming of the change-data library."""
