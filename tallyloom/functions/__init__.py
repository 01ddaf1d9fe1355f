"""Column expressions: no function in this package starts a job or leaves the JVM."""
