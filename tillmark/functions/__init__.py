"""Column helpers built only from JVM-side expressions."""
