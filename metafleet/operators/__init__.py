"""Operators on DataFrames: identity, merges, history, gates, status, drift and rules."""
