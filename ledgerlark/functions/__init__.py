"""Column helpers that pin the reference dialect's semantics on Spark."""
