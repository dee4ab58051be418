"""The tables of the warehouse, each a function from DataFrames to a DataFrame."""
