"""Labelled-article analytics on Spark DataFrames."""
