"""Forum-post analytics on Spark DataFrames and Structured Streaming."""
