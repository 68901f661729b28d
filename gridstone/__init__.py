"""Curated, reproducible subsets of time-stamped recordings on Spark DataFrames."""
