"""Column functions: everything here builds JVM-side expressions, no Python UDFs."""
