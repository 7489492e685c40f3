"""Column functions: everything here is a built-in expression, nothing leaves the JVM."""
