"""Column expressions: everything here runs inside the JVM, none of it is a Python UDF."""
