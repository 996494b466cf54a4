"""Market-data and factor analytics on Spark DataFrames."""
