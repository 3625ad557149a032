"""Point-in-time feature engine on Spark DataFrames."""
