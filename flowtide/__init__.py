"""A change-stream analytics engine on Spark DataFrames."""
