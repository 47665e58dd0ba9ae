"""Column functions: text, conversion, categories, calendar and rule predicates."""
