"""Road traffic, weather and accident-risk analytics on Spark DataFrames."""

__version__ = "0.1.0"
