"""Column expressions; all JVM-side built-ins."""
