"""Column-level functions. Everything here returns a Spark ``Column``."""
