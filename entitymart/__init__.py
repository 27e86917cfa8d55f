"""Link, check and count company and model records with Spark DataFrames."""
