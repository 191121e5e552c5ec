"""Column expressions; all run inside the JVM, no Python per row."""
