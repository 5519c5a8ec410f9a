"""Column functions: text, dates, casts, arrays, predicates and aggregates."""
