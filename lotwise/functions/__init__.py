"""Column builders: they take and give columns, and run inside the JVM."""
