"""Operators on line tables: duplicates, emails, joins, positions, statistics, file names."""
