"""Column helpers (scalar expressions, all built-in)."""
