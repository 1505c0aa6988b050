"""Serving tables: their schemas, and the batch run that fills every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hazemart.functions.coerce import coerce_to
from hazemart.operators.cleaning import CONTEXT_COLUMNS, READING_COLUMNS, CleaningAudit, clean_context, clean_readings
from hazemart.operators.notices import NOTICE_HOUR_COLUMNS, notice_hours
from hazemart.plans import marts
from hazemart.plans.views import serving_views, stream_views, view_sql
from hazemart.sources import publication, sinks
from hazemart.streaming.events import WINDOW_COLUMNS

# The columns of the serving tables and their types.
_COLUMN_TYPES = {
    "int": (
        "site_id", "hour", "month", "regime_level", "cluster", "actual_peak", "predicted_peak", "project_id",
    ),
    "bigint": (
        "rows_count", "pollution_peak_count", "precipitation_hours", "missing_weather_rows", "missing_pollution_rows",
        "site_count", "peak_count", "sample_count",
    ),
    "string": (
        "site_name", "project_name", "project_short_name", "raw_json", "regime", "announcement_text", "wind_speed_group",
        "model", "task", "metric", "feature",
    ),
    "boolean": ("is_pollution_peak", "has_missing_pollution_value", "has_precipitation", "is_nmu"),
    "timestamp": ("timestamp", "first_timestamp", "last_timestamp", "window_start", "window_end"),
    "date": ("date",),
    "double": (
        "latitude", "longitude", "aqi", "iaqi", "pm25", "pm25_mcp", "pm10", "temperature", "humidity", "pressure",
        "air_temperature", "air_humidity", "air_pressure", "weather_temperature", "weather_humidity", "wind_speed",
        "wind_direction", "precipitation", "rain", "snowfall", "surface_pressure", "total_precipitation", "value", "importance",
        "actual_aqi", "predicted_aqi", "abs_error", "peak_probability", "nmu_share", "peak_share", "avg_nmu_severity",
        "avg_aqi", "max_aqi", "avg_pm25", "max_pm25", "avg_pm10", "max_pm10", "avg_weather_temperature",
        "avg_weather_humidity", "avg_wind_speed", "avg_surface_pressure",
    ),
}
_SPARK_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(), "double": T.DoubleType(),
}
_TYPES = {column: name for name, columns in _COLUMN_TYPES.items() for column in columns}


def _schema(columns, **other: str) -> T.StructType:
    """The declared type of every column; a name without one is an error."""
    unknown = [c for c in columns if c not in _TYPES and c not in other]
    if unknown:
        raise KeyError(f"no type is declared for: {', '.join(unknown)}")
    return T.StructType([T.StructField(c, _SPARK_TYPES[other.get(c, _TYPES.get(c))]) for c in columns])


SERVING_SCHEMAS = {
    "air_sites": _schema(
        ["site_id", "site_name", "project_id", "project_name", "project_short_name", "latitude", "longitude", "raw_json"]
    ),
    "air_cleaned": _schema(READING_COLUMNS),
    "weather_cleaned": _schema(CONTEXT_COLUMNS),
    "nmu_hourly": _schema(NOTICE_HOUR_COLUMNS),
    "mart_air_weather_hourly": _schema([*marts.HOURLY_READING_COLUMNS.values(), *marts.HOURLY_CONTEXT_COLUMNS]),
    "mart_air_weather_daily": _schema(
        ["date", "site_id", "rows_count", "avg_aqi", "max_aqi", "avg_pm25", "max_pm25", "avg_pm10", "max_pm10",
         "avg_weather_temperature", "avg_weather_humidity", "avg_wind_speed", "total_precipitation",
         "pollution_peak_count", "precipitation_hours"]
    ),
    "mart_pollution_by_wind": _schema(
        ["site_id", "wind_speed_group", "rows_count", "avg_aqi", "avg_pm25", "avg_pm10", "pollution_peak_count"]
    ),
    "mart_data_quality_summary": _schema(
        ["rows_count", "missing_weather_rows", "missing_pollution_rows", "site_count", "first_timestamp", "last_timestamp"]
    ),
    "ml_regression_predictions": _schema(
        ["site_id", "timestamp", "date", "hour", "model", "actual_aqi", "predicted_aqi", "abs_error"]
    ),
    "ml_classification_predictions": _schema(
        ["site_id", "timestamp", "date", "hour", "model", "actual_peak", "predicted_peak", "peak_probability"]
    ),
    "ml_metrics": _schema(["task", "model", "metric", "value"]),
    "ml_feature_importance": _schema(["task", "model", "feature", "importance"]),
    "ml_clusters": _schema(
        ["site_id", "timestamp", "date", "hour", "cluster", "aqi", "pm25", "weather_temperature", "wind_speed", "is_nmu"],
        is_nmu="int",
    ),
    "mart_stream_aggregates": _schema(WINDOW_COLUMNS),
    "ml_cluster_profile": _schema(
        ["cluster", "rows_count", "avg_aqi", "avg_pm25", "avg_pm10", "avg_weather_temperature", "avg_weather_humidity",
         "avg_wind_speed", "avg_surface_pressure", "avg_nmu_severity", "nmu_share", "peak_share"]
    ),
}


def serving_table(name: str, df: DataFrame) -> DataFrame:
    """``df`` with the columns and types of the serving table; unknown booleans become false."""
    return coerce_to(df, SERVING_SCHEMAS[name], unknown_bool=False)


def build_layers(
    spark: SparkSession, raw_readings: DataFrame, raw_context: DataFrame, notices: DataFrame, root: str,
    audit: CleaningAudit | None = None,
) -> dict[str, DataFrame]:
    """Staging and marts as Parquet below ``root``, each layer read back by the next.

    Every raw table is scanned once and the join runs once; the three marts read the hourly one. ``audit`` is
    filled by the pass that writes the readings.
    """
    staging, mart = f"{root}/staging", f"{root}/marts"
    cleaned = audit.clean(raw_readings) if audit else clean_readings(raw_readings)
    sinks.write_staging(cleaned, f"{staging}/readings")
    sinks.write_staging(clean_context(raw_context), f"{staging}/context", partition=None)
    sinks.write_staging(notice_hours(notices), f"{staging}/notice_hours", partition=None)
    readings = spark.read.parquet(f"{staging}/readings").select(*READING_COLUMNS)
    context = spark.read.parquet(f"{staging}/context")
    hours = spark.read.parquet(f"{staging}/notice_hours")

    sinks.write_staging(marts.hourly_mart(readings, context), f"{mart}/hourly")
    hourly = spark.read.parquet(f"{mart}/hourly")
    for name, build in (("daily", marts.daily_mart), ("bucket", marts.bucket_mart), ("quality", marts.quality_mart)):
        sinks.write_staging(build(hourly), f"{mart}/{name}", partition=None)
    return {
        "air_cleaned": readings,
        "weather_cleaned": context,
        "nmu_hourly": hours,
        "mart_air_weather_hourly": hourly,
        "mart_air_weather_daily": spark.read.parquet(f"{mart}/daily"),
        "mart_pollution_by_wind": spark.read.parquet(f"{mart}/bucket"),
        "mart_data_quality_summary": spark.read.parquet(f"{mart}/quality"),
    }


def publish(tables: dict[str, DataFrame], location: str | None = None, keep: int = 2) -> int:
    """Coerce and replace the serving tables and the views over them as one set; the version that is current now.

    A view that only renames, joins names or marks rows is a catalog view; one that groups is stored
    with the tables it reads. With the windows of the stream their views are published too. The catalog of the session
    gets a view for every name, all over the new version; ``keep`` versions stay for readers of older plans.
    ``location`` is by default a folder of the warehouse.
    """
    spark = next(iter(tables.values())).sparkSession
    place = location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/serving-set"
    shaped = {name: serving_table(name, df) for name, df in tables.items()}
    texts = view_sql({name: table.columns for name, table in shaped.items()})

    def grouped(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        views = serving_views(stored)
        if "mart_stream_aggregates" in stored:
            views |= stream_views(stored["mart_stream_aggregates"])
        return {name: df for name, df in views.items() if name not in texts}

    version = publication.publish_set(spark, place, shaped, grouped)
    publication.point_views(spark, place, texts)
    publication.prune(spark, place, keep)
    return version
