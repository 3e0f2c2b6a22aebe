"""Column functions: text rules, pattern dictionaries, scores."""
