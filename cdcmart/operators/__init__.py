"""Operators: DataFrames in, DataFrames out, lazy, no state of their own."""
