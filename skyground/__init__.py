"""Correlating two feeds of located, timestamped observations with Spark DataFrames."""
