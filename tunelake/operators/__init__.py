"""Operators: each takes DataFrames and gives a DataFrame."""
