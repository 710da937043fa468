"""Sources of the change-data library."""
