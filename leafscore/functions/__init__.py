"""Column expressions: text helpers (JVM side) and vector helpers (Arrow batches)."""
