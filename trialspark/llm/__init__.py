"""Operators for building training corpora, each a function from DataFrames to a DataFrame."""
