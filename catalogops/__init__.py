"""Curation of large hierarchical reference data on Spark DataFrames."""
