"""blocklot: housing and geography data products on Spark DataFrames."""

__version__ = "0.1.0"
