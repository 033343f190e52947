"""Column -> Column building blocks (no jobs, no shuffles)."""
