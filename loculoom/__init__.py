"""Genotyping-array analytics on Spark DataFrames."""
