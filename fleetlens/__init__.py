"""Device-fleet telemetry analytics and data-health checks on Spark DataFrames."""
