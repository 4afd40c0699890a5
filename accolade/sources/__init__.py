"""Reading, normalising and writing tables."""
