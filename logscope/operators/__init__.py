"""Operators: each a function of DataFrames returning a DataFrame."""
