"""Customer lifetime value."""
