"""Serving views over readings, marts, model tables and stream windows.

A view that groups by site takes the site name from the dimension after grouping: the join then
sees one row per group instead of every reading. The dimension is unique in ``site_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart.operators.compare import notice_periods
from hazemart.operators.joins import attach_names
from hazemart.plans.marts import average_and_top, averages, missing_count, peak_count, rows_count


def named(df: DataFrame, sites: DataFrame) -> DataFrame:
    """``df`` with ``site_name`` right after ``site_id``, null for unknown sites."""
    order = list(df.columns)
    order.insert(order.index("site_id") + 1, "site_name")
    return attach_names(df, sites, "site_id", ["site_name"]).select(*order)


def daily_by_site(readings: DataFrame, sites: DataFrame) -> DataFrame:
    grouped = readings.groupBy("date", "site_id").agg(
        rows_count(),
        *average_and_top("aqi", "pm25", "pm10"),
        *averages("temperature", "humidity", "pressure"),
        peak_count(),
        missing_count(),
    )
    return named(grouped, sites)


def hourly_profile(readings: DataFrame, sites: DataFrame) -> DataFrame:
    grouped = readings.groupBy("site_id", "hour").agg(
        rows_count(), *averages("aqi", "pm25", "pm10", "temperature"), peak_count()
    )
    return named(grouped, sites)


def site_summary(readings: DataFrame, sites: DataFrame) -> DataFrame:
    grouped = readings.groupBy("site_id").agg(
        rows_count(),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        *average_and_top("aqi", "pm25", "pm10"),
        peak_count(),
        missing_count(),
    )
    return named(grouped, sites)


def classification_view(scores: DataFrame, sites: DataFrame) -> DataFrame:
    return named(scores, sites).withColumn("is_correct", is_correct())


def is_correct():
    return F.when(F.col("actual_peak") == F.col("predicted_peak"), 1).otherwise(0)


def _decimal_mean(name: str):
    """Mean of one-place values, taken in decimals so that no half depends on the order of the sum."""
    value = F.col(name)
    mean = F.round(F.avg(value.try_cast("decimal(18,6)")), 1).cast("double")
    return F.when(F.bool_or(F.isnan(value)), F.lit(float("nan"))).otherwise(mean).alias(name)


def stream_site_summary(windows: DataFrame) -> DataFrame:
    """Per site over its windows. The mean is that of the window means, unweighted."""
    return windows.groupBy("site_id", "site_name").agg(
        F.count(F.lit(1)).alias("window_count"),
        F.sum("sample_count").alias("total_samples"),
        _decimal_mean("avg_aqi"),
        F.max("max_aqi").alias("max_aqi"),
        _decimal_mean("avg_pm25"),
        F.sum("peak_count").alias("peak_count"),
    )


def serving_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The batch views by name, from the serving tables by name."""
    readings, sites = tables["air_cleaned"], tables["air_sites"]
    return {
        "v_air_daily_by_site": daily_by_site(readings, sites),
        "v_air_hourly_profile": hourly_profile(readings, sites),
        "v_air_site_summary": site_summary(readings, sites),
        "v_air_weather_daily_by_site": named(tables["mart_air_weather_daily"], sites),
        "v_pollution_by_wind": named(tables["mart_pollution_by_wind"], sites),
        "v_data_quality_summary": tables["mart_data_quality_summary"],
        "v_pollution_by_nmu": notice_periods(readings, tables["nmu_hourly"]),
        "v_ml_regression": named(tables["ml_regression_predictions"], sites),
        "v_ml_classification": classification_view(tables["ml_classification_predictions"], sites),
        "v_ml_clusters": named(tables["ml_clusters"], sites),
        "v_ml_cluster_profile": tables["ml_cluster_profile"],
        "v_ml_metrics": tables["ml_metrics"],
        "v_ml_feature_importance": tables["ml_feature_importance"],
    }


def view_sql(columns: dict[str, list[str]]) -> dict[str, str]:
    """SELECT statements of the views that do not group, from the columns of the serving tables by name.

    Tables stand in braces, to be filled with where they are.
    """

    def with_site(table: str, more: str = "") -> str:
        order = ", ".join(f"t.{c}, s.site_name" if c == "site_id" else f"t.{c}" for c in columns[table])
        return f"SELECT {order}{more} FROM {{{table}}} t LEFT JOIN {{air_sites}} s ON t.site_id = s.site_id"

    correct = ", CASE WHEN t.actual_peak = t.predicted_peak THEN 1 ELSE 0 END AS is_correct"
    texts = {
        "v_air_weather_daily_by_site": ("mart_air_weather_daily", ""), "v_pollution_by_wind": ("mart_pollution_by_wind", ""),
        "v_ml_regression": ("ml_regression_predictions", ""), "v_ml_clusters": ("ml_clusters", ""),
        "v_ml_classification": ("ml_classification_predictions", correct),
    }
    whole = {
        "v_data_quality_summary": "mart_data_quality_summary", "v_ml_cluster_profile": "ml_cluster_profile",
        "v_ml_metrics": "ml_metrics", "v_ml_feature_importance": "ml_feature_importance",
        "v_stream_aggregates": "mart_stream_aggregates",
    }
    return {
        **{view: with_site(table, more) for view, (table, more) in texts.items() if table in columns},
        **{view: f"SELECT * FROM {{{table}}}" for view, table in whole.items() if table in columns},
    }


def stream_views(windows: DataFrame) -> dict[str, DataFrame]:
    return {"v_stream_aggregates": windows, "v_stream_site_summary": stream_site_summary(windows)}
