"""Column-level helpers that stay inside JVM expressions."""
