"""Quality analytics for extracted documents, on Spark DataFrames."""
