"""Operators over observation series, each a function of DataFrames."""
