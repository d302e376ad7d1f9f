"""Machine-telemetry analytics as plain Spark DataFrame transformations."""
