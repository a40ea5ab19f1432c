"""Column builders: each takes columns and returns a column, and stays inside JVM codegen."""
