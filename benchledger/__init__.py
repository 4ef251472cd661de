"""Benchmark-results analytics on Spark DataFrames."""
