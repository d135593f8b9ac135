"""Electricity-market analytics on Spark DataFrames."""
