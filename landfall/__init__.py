"""Landfall: a travel-arrivals data lake built with PySpark DataFrames."""
