"""Relational operators of the warehouse, as functions from DataFrames to DataFrames."""
