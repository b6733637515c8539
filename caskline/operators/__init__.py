"""Functions from DataFrames to lazy DataFrames."""
