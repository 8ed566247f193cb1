"""Panel demand decomposition on Spark DataFrames."""
