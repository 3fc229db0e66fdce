"""Keep analytical copies of operational tables correct at scale, with Spark DataFrames."""
