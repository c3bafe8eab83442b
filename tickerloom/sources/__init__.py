"""Readers that turn snapshot files into DataFrames."""
