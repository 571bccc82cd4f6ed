"""heliotab: survey analytics on Spark DataFrames."""
