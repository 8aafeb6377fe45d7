"""streaming of scorewright."""
