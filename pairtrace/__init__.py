"""Pair-locking analytics on Spark DataFrames."""
