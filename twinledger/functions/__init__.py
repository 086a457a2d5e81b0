"""Column expressions: normalisation, accepted-difference predicates, display."""
