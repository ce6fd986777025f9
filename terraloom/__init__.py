"""Terraloom: spatial-temporal analytics on Spark DataFrames."""
