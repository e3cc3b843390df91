"""Register-versus-observation reconciliation on Spark DataFrames."""
