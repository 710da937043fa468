"""Plans of the change-data library."""
