"""Table definitions and table administration."""
