"""Plot-based diversity and time-series analytics on Spark DataFrames."""
