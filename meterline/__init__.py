"""meterline: a trip-data lake built from Spark DataFrames, SQL and Structured Streaming."""
