"""Cleaning and querying of wide sensor time series with PySpark DataFrames."""
