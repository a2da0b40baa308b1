"""Cleaned entities, dimensions, facts and reports."""
