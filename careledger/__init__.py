"""Facility-reporting warehouse built from landed JSON responses with Spark DataFrames."""
