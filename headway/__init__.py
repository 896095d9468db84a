"""Public-transit analytics on Spark DataFrames."""
