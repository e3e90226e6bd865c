"""Column expressions: every one stays inside the JVM, none is a Python UDF."""
