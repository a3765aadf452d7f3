"""Analytics of multi-track sessions, and operators for training data, on Spark DataFrames."""
