"""Spark-native analytics for vehicle telemetry feeds."""
