"""League analytics on Spark DataFrames."""
