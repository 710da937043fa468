"""Functions of the change-data library."""
