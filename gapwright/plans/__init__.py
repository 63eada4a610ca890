"""The composite jobs, each a function from DataFrames to a DataFrame."""
