"""functions of scorewright."""
