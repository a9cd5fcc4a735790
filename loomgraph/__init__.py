"""Document retrieval, knowledge-graph and integrity operators on Spark DataFrames."""
