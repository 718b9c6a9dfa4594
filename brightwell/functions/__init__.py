"""Column expressions: all of them stay inside the JVM unless they say otherwise."""
