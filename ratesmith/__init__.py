"""Currency rates and trade valuation on Spark DataFrames."""
