"""Case-based analytics on Spark DataFrames."""
