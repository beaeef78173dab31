"""Column builders: row-local expressions that stay inside the JVM."""
