"""Relational operators of the margin job (filters, joins, dedup, reshaping, bucketing,
gap fill, volatility, XML scope, file-arrival control)."""
