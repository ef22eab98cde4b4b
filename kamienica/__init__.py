"""Listings cleansing, profiling and feature building on Spark DataFrames."""
