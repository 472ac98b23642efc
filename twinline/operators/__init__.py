"""Operators on DataFrames of sentence pairs."""
