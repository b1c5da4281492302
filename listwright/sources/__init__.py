"""Scans: the registry, line tables, data files and the file manifest."""
