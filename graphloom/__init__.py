"""graphloom: page text to searchable terms and an analysed entity graph, on Spark DataFrames."""
