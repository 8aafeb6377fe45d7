"""operators of scorewright."""
