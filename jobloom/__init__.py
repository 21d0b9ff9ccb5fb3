"""Job-posting collection and coding on Spark DataFrames."""
