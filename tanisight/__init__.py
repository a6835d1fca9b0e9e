"""Commodity-price early warning on Spark: every step is DataFrames in, DataFrame out."""
