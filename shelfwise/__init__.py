"""Retail inventory analytics on Spark DataFrames."""
