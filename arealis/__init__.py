"""Regional statistics and boundary analytics on Spark DataFrames."""
