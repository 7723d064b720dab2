"""Column-expression helpers (JVM-side, codegen friendly) and code lists."""
