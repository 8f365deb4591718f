"""Operators for preparing large training corpora, each one function from DataFrames to a DataFrame."""
