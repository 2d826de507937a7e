"""Distributed operators: DataFrames in, DataFrames out."""
