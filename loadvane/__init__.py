"""Hourly demand and weather analytics on Spark DataFrames."""
