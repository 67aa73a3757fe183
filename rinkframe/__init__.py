"""League analytics on Spark DataFrames: pure operators over canonical tables."""
