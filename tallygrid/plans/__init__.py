"""The driver's tables as logical tables, and the query catalogue over them."""
