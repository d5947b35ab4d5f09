"""Analytics on semi-structured public notices, expressed as Spark DataFrames."""
