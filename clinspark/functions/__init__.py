"""Column functions: built-in Spark expressions, and two vectorised similarity functions."""
