"""Combinatorial-library analytics on Spark DataFrames."""
