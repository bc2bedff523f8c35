"""Telemetry analytics as plain Spark DataFrame operators."""
