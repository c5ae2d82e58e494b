"""Positional documents and training-data curation on Spark DataFrames."""
