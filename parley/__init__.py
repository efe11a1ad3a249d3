"""Earnings-guidance analytics and training-data operators on Spark DataFrames."""
