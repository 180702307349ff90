"""Scientific-record linking and ranking on Spark DataFrames."""
