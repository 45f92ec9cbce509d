"""lakework: medallion-style lake jobs on Spark DataFrames and Structured Streaming."""
