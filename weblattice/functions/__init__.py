"""Column functions: each takes and returns Spark columns, all on the JVM side."""
