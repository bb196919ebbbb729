"""Analytics for a fleet of coin-operated karaoke machines, on Spark DataFrames."""
