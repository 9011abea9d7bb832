"""Page extraction, passage retrieval and retrieval evaluation on Spark DataFrames."""
