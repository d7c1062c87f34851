"""Agent-telemetry analytics on Spark: bronze exports -> spans -> conversation hierarchy."""
