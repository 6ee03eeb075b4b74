"""Relational operators of the pipeline, each a function on DataFrames."""
