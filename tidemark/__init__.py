"""Payments lakehouse analytics on Spark: every operator takes DataFrames and returns a DataFrame."""
