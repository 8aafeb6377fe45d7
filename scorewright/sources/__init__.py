"""sources of scorewright."""
