"""Operators on listings: DataFrames to DataFrames, lazily."""
