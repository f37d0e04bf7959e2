"""tidemark - price history, matching and trend operators as Spark DataFrames."""
