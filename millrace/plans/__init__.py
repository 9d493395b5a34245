"""Business marts."""
