"""Marker-gene data sets as Spark DataFrames."""
