"""Operators over whole DataFrames."""
