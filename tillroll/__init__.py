"""Retail analytics as Spark jobs: every operator maps DataFrames to a DataFrame."""
