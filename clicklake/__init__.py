"""clicklake: search-log analytics on Spark DataFrames."""
