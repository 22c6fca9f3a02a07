"""Column functions; every one returns a Spark ``Column``."""
