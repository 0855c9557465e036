"""graphloom: declarative property-graph analytics on Spark DataFrames."""
