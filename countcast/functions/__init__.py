"""Column expressions; all of them are built-in functions that stay on the JVM."""
