"""Operators of the change-data library."""
