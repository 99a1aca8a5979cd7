"""Distributed work-log analytics on Spark DataFrames."""
