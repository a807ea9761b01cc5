"""Column functions: native Spark expressions, no row-at-a-time Python."""
