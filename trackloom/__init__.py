"""Vehicle GPS trajectory cleaning on Spark DataFrames and streams."""
