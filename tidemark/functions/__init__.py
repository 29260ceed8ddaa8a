"""Column functions: everything here is a JVM-side expression."""
