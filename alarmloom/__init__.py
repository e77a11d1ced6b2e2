"""Rule-driven monitoring of device telemetry, written as Spark jobs."""

__version__ = "0.1.0"
