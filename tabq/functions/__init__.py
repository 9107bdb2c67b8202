"""Column builders: patterns, predicates and ANSI-safe conversions."""
