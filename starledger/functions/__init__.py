"""Column functions: cleaning, names, orbit regime, similarity."""
