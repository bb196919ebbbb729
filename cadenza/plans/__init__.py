"""The daily jobs, each a function from DataFrames and a run date to a DataFrame."""
