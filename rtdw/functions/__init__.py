"""Column functions: times, names, text and JSON. All are built from Spark's own expressions."""
