"""Operators from DataFrames to DataFrames; none of them reads or writes storage."""
