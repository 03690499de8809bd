"""Retail sales analytics on Spark DataFrames."""
