"""Operators: DataFrames in, a DataFrame out. None takes a path or collects rows."""
