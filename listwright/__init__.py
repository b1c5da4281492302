"""Consolidation of large lists of short strings on Spark."""
