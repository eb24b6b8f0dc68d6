"""See the package docstring of scorewright."""
