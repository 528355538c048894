"""DataFrame operators: dedup, joins, merge, validation and comparison."""
