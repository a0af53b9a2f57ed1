"""Column-level helpers built from Spark's own functions (no Python UDFs)."""
