"""Finds unusual network connections in flow records, on Spark DataFrames."""
