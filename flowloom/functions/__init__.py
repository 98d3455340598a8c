"""Column-level building blocks (no joins, no shuffles)."""
