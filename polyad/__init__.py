"""Entity-year panels and directed entity-pair tables on Spark DataFrames."""
