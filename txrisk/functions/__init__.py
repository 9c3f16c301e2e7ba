"""Column expressions used by the operators (all JVM-side built-ins)."""
