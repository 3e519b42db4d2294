"""Reusable DataFrame operators: dedupe, joins, ranking, statistics."""
