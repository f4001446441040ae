"""Functions of the engine: plain functions from DataFrames to DataFrames."""
