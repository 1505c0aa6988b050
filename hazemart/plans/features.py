"""Readings, weather and notices joined into one row of model features per reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart.functions.derive import fill, severity
from hazemart.operators.joins import attach_context

READING_FEATURES = ("site_id", "timestamp", "hour", "month", "aqi", "pm25", "pm10")
CONTEXT_FEATURES = (
    "weather_temperature", "weather_humidity", "precipitation", "snowfall", "surface_pressure",
    "wind_speed", "wind_direction",
)


def feature_table(readings: DataFrame, context: DataFrame, notice_hours: DataFrame) -> DataFrame:
    """No notice counts as level 0, severity 0 and empty text."""
    facts = readings.select(*READING_FEATURES, F.col("is_pollution_peak").cast("int").alias("is_pollution_peak"))
    notices = notice_hours.select(
        "timestamp",
        F.col("regime_level").alias("nmu_regime_level"),
        F.lit(1).alias("nmu_present"),
        "announcement_text",
    )
    joined = attach_context(attach_context(facts, context.select("timestamp", *CONTEXT_FEATURES)), notices)
    filled = joined.withColumns(fill({"nmu_present": 0, "nmu_regime_level": 0, "announcement_text": ""}))
    return filled.withColumns(
        {
            "is_nmu": F.col("nmu_present"),
            "nmu_severity": severity(F.col("nmu_present"), F.col("nmu_regime_level")),
            "date": F.to_date("timestamp"),
        }
    )
