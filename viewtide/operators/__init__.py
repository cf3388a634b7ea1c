"""Transformations of DataFrames: quality, cleaning, star join, metrics, windows."""
