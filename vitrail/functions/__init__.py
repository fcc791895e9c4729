"""Column-level helpers (text folding, numeric rounding, vector distances)."""
