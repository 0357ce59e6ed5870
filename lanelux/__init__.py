"""lanelux: road-marking survey analytics on Spark DataFrames."""
