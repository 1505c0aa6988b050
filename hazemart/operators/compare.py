"""Comparisons over periods, seasons, sites and weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart import config
from hazemart.functions.derive import count_if, share_of

# fixed values: month -> season
SEASONS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}


def notice_periods(
    readings: DataFrame,
    notice_hours: DataFrame,
    measures: Sequence[str] = ("aqi", "pm25", "pm10"),
    inside: str = config.NOTICE_PERIOD_LABEL,
    outside: str = config.ORDINARY_PERIOD_LABEL,
) -> DataFrame:
    """Hours under notice against ordinary hours.

    Readings are summed per hour before the join, so the join sees one row per hour however
    many readings an hour has.
    """
    per_hour = readings.groupBy("timestamp").agg(
        F.count(F.lit(1)).alias("_rows"),
        count_if(F.col("is_pollution_peak")).alias("_peaks"),
        *[F.sum(m).alias(f"_sum_{m}") for m in measures],
        *[F.count(m).alias(f"_count_{m}") for m in measures],
    )
    marks = notice_hours.select("timestamp").distinct().withColumn("_hit", F.lit(True))
    marked = per_hour.join(marks, "timestamp", "left")
    status = F.when(F.col("_hit"), F.lit(inside)).otherwise(F.lit(outside)).alias("nmu_status")
    return marked.groupBy(status).agg(
        F.sum("_rows").alias("rows_count"),
        *[F.try_divide(F.sum(f"_sum_{m}"), F.sum(f"_count_{m}")).alias(f"avg_{m}") for m in measures],
        F.sum("_peaks").alias("pollution_peak_count"),
        (F.sum("_peaks") / F.sum("_rows")).alias("pollution_peak_share"),
    )


def by_weekend(df: DataFrame, when: str, value: str) -> DataFrame:
    is_weekend = F.dayofweek(when).isin(1, 7)
    return df.groupBy(F.when(is_weekend, "weekend").otherwise("weekday").alias("day_kind")).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value")
    )


def by_season(df: DataFrame, when: str, value: str) -> DataFrame:
    season = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        season = F.when(F.month(when).isin(*months), name).otherwise(season)
    return df.groupBy(season.alias("season")).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value")
    )


def by_week(df: DataFrame, keys: Sequence[str], when: str, value: str, threshold: float) -> DataFrame:
    return df.groupBy(*keys, F.to_date(F.date_trunc("WEEK", when)).alias("week_start")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(value).alias("avg_value"),
        F.max(value).alias("max_value"),
        count_if(F.col(value) > threshold).alias("peak_count"),
    )


def weather_correlation(joined: DataFrame, value: str, factors: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.corr(value, f).alias(f"corr_{f}") for f in factors]
    )


def mean_by_bucket(joined: DataFrame, bucket: str, value: str) -> DataFrame:
    return joined.groupBy(bucket).agg(F.count(F.lit(1)).alias("row_count"), F.avg(value).alias("avg_value"))


def latest_and_mean(df: DataFrame, site: str, order: Sequence[str], value: str) -> DataFrame:
    """Per site the newest reading beside the mean of the period. One pass, combined on the map side."""
    newest = F.max_by(F.struct(F.col(value).alias("v"), F.col(order[0]).alias("t")), F.struct(*order))
    return (
        df.groupBy(site)
        .agg(newest.alias("_newest"), F.avg(value).alias("mean_value"))
        .select(
            site,
            F.col("_newest.t").alias("latest_time"),
            F.col("_newest.v").alias("latest_value"),
            "mean_value",
            (F.col("_newest.v") - F.col("mean_value")).alias("difference"),
        )
    )


def quota_share(df: DataFrame, site: str, when: str, value: str, quota: float) -> DataFrame:
    """Share of days whose maximum stays within ``quota``."""
    daily = df.groupBy(site, F.to_date(when).alias("date")).agg(F.max(value).alias("_daily_max"))
    return daily.groupBy(site).agg(
        F.count(F.lit(1)).alias("observed_days"), share_of(F.col("_daily_max") <= quota).alias("share_within_quota")
    )


def sites_as_columns(df: DataFrame, site: str, sites: Sequence, when: str, value: str) -> DataFrame:
    """Daily mean with one column per named site; naming them saves the pass that would find them."""
    return df.groupBy(F.to_date(when).alias("date")).pivot(site, list(sites)).agg(F.avg(value))
