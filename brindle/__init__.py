"""Brindle: an analytics engine written for Spark DataFrames and SQL."""
