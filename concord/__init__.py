"""Keeping record collections from several systems consistent, on Spark DataFrames."""
