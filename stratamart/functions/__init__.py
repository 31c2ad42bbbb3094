"""Column expressions; all compile to JVM-side built-ins."""
