"""Spark-native analytics for hourly site readings, context, notices and event streams."""

__version__ = "0.1.0"
