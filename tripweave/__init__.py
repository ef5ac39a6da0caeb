"""tripweave: shared-vehicle trip analytics as plain Spark DataFrames."""
