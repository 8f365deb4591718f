"""Whole flows put together from the operators."""
