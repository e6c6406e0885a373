"""Layered (bronze, silver, gold) table building on Spark DataFrames."""
