"""Table reconciliation on Spark."""
