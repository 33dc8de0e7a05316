"""Column functions: kinds, conversions and text forms."""
