"""Column expressions used by more than one layer."""
