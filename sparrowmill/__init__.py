"""Dataset preparation and evaluation operators written as plain Spark DataFrame code."""
