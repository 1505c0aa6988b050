"""Hourly, daily, bucket and quality marts. Sorting is left to whoever presents them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart import config
from hazemart.functions.derive import count_if
from hazemart.operators.dedup import first_per_key
from hazemart.operators.joins import attach_context

HOURLY_READING_COLUMNS = {
    "site_id": "site_id", "timestamp": "timestamp", "date": "date", "hour": "hour", "month": "month",
    "aqi": "aqi", "pm25": "pm25", "pm10": "pm10",
    "temperature": "air_temperature", "humidity": "air_humidity", "pressure": "air_pressure",
    "is_pollution_peak": "is_pollution_peak",
    "has_missing_pollution_value": "has_missing_pollution_value",
}
HOURLY_CONTEXT_COLUMNS = (*config.CONTEXT_LIMITS, "wind_speed_group", "has_precipitation")


def hourly_mart(readings: DataFrame, context: DataFrame, context_is_unique: bool = True) -> DataFrame:
    """Every reading with the weather of its hour; hours without weather keep nulls.

    ``context_is_unique`` is what :func:`clean_context` promises; pass False for other tables.
    """
    if not context_is_unique:
        context = first_per_key(context, ["timestamp"], [c for c in context.columns if c != "timestamp"])
    facts = readings.select(*[F.col(c).alias(name) for c, name in HOURLY_READING_COLUMNS.items()])
    return attach_context(facts, context.select("timestamp", *HOURLY_CONTEXT_COLUMNS)).select(
        *HOURLY_READING_COLUMNS.values(), *HOURLY_CONTEXT_COLUMNS
    )


def averages(*names: str, digits: int | None = None) -> list[Column]:
    means = {n: F.avg(n) if digits is None else F.round(F.avg(n), digits) for n in names}
    return [mean.alias(f"avg_{n}") for n, mean in means.items()]


def average_and_top(*names: str, digits: int | None = None) -> list[Column]:
    return [c for n in names for c in (*averages(n, digits=digits), F.max(n).alias(f"max_{n}"))]


def rows_count(name: str = "rows_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def peak_count(name: str = "pollution_peak_count") -> Column:
    return count_if(F.col("is_pollution_peak")).alias(name)


def missing_count() -> Column:
    return count_if(F.col("has_missing_pollution_value")).alias("missing_pollution_count")


def daily_mart(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("date", "site_id").agg(
        rows_count(),
        *average_and_top("aqi", "pm25", "pm10"),
        *averages("weather_temperature", "weather_humidity", "wind_speed"),
        F.sum("precipitation").alias("total_precipitation"),
        peak_count(),
        count_if(F.col("has_precipitation")).alias("precipitation_hours"),
    )


def bucket_mart(hourly: DataFrame) -> DataFrame:
    """By site and wind bucket; readings without weather form the null bucket."""
    return hourly.groupBy("site_id", "wind_speed_group").agg(
        rows_count(), *averages("aqi", "pm25", "pm10"), peak_count()
    )


def quality_mart(hourly: DataFrame) -> DataFrame:
    """One row. A matched hour whose temperature was clamped also counts as missing weather."""
    return hourly.agg(
        rows_count(),
        count_if(F.col("weather_temperature").isNull()).alias("missing_weather_rows"),
        count_if(F.col("has_missing_pollution_value")).alias("missing_pollution_rows"),
        F.count_distinct("site_id").alias("site_count"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )
