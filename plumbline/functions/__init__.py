"""Column-level building blocks: predicates, shares, assertions and type names."""
