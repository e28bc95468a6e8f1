"""Reading and writing the logical tables."""
