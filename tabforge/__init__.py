"""tabforge package."""
