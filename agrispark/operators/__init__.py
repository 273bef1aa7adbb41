"""Operators by area: each takes DataFrames and returns a DataFrame; the registered queries stand beside them."""
