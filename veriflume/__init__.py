"""Citation-evidence analytics on Spark DataFrames."""
