"""Joins, aggregates, windows and reshaping over DataFrames."""
