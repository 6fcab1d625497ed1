"""Supply-chain warehouse analytics as plain Spark DataFrame functions."""
