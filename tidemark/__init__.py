"""Event-stream operators on Spark DataFrames."""
