"""Contact-outreach analytics on Spark DataFrames."""
