"""Column functions made of Spark built-ins."""
