"""Column expressions. Every function takes and returns columns and runs inside the JVM."""
