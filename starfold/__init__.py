"""starfold: build and query dimensional warehouses with plain Spark DataFrames."""
