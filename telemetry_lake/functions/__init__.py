"""Column helpers built only from JVM-side Spark expressions."""
