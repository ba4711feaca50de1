"""seqtally: sequencing-derived tables as Spark DataFrames."""
