"""Feed-to-fact batch analytics on Spark DataFrames."""
