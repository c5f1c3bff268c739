"""Audit analytics over structured business documents, on Spark DataFrames."""
