"""Operators: point sets, grid outliers, k-center, items, sampling, joins."""
