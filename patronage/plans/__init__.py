"""Operators joined into whole jobs, and the look-ups over their results."""
