"""Column expressions: Column in, Column out. All JVM-side built-ins."""
