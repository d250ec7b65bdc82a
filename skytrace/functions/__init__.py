"""Column-expression building blocks (pure JVM-side Spark functions)."""
