"""Bag-of-words document classification on Spark DataFrames."""
