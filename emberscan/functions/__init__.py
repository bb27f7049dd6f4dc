"""Column-level rules; everything here is a Catalyst expression."""
