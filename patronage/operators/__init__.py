"""Analytic operators: each takes and returns DataFrames."""
