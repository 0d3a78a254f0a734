"""Interaction datasets for recommenders, computed with Spark DataFrames."""
