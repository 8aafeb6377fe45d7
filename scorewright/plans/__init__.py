"""plans of scorewright."""
