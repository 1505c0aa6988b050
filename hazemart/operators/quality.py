"""Control of the measured tables: gaps, duplicates, suspicious values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart.functions.derive import count_if
from hazemart.operators.intervals import expand_intervals
from hazemart.operators.ordered import previous_value
from hazemart.session import settled


def gap_intervals(df: DataFrame, site: str = "site_id", when: str = "timestamp") -> DataFrame:
    """(site, gap_start, gap_end, hours): what every site lacks between the first and last hour of the table, end excluded.

    A gap lies between an hour and the one before it, so it takes one row whatever its length. Rows without a site are a
    site of their own.
    """
    hour = F.date_trunc("HOUR", when)
    # read by the span, by the ends of the sites and by the hours before
    seen = settled(df.where(F.col(when).isNotNull()).select(site, hour.alias("gap_end")).distinct(), "hours")
    span = seen.agg(F.min("gap_end").alias("first"), F.max("gap_end").alias("last"))
    step = F.expr("INTERVAL 1 HOUR")
    before = previous_value(seen.withColumn("_hour", F.col("gap_end")), [site], ["gap_end"], "_hour", F.date_trunc("DAY", "gap_end"), "_before")
    inner = before.select(site, F.coalesce(F.col("_before") + step, span.select("first").scalar()).alias("gap_start"), "gap_end")
    tail = seen.groupBy(site).agg((F.max("gap_end") + step).alias("gap_start")).withColumn("gap_end", span.select("last").scalar() + step)
    hours = (F.unix_timestamp("gap_end") - F.unix_timestamp("gap_start")) / 3600
    return inner.unionByName(tail).where(F.col("gap_start") < F.col("gap_end")).withColumn("hours", hours.cast("long"))


def hourly_gaps(df: DataFrame, site: str = "site_id", when: str = "timestamp") -> DataFrame:
    """Hours between the first and last hour of the table that a site has no row for.

    Only the gaps are expanded, in pieces; hours that are there are never laid out.
    """
    return expand_intervals(gap_intervals(df, site, when), "gap_start", "gap_end", "hour_start").select(site, "hour_start")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def suspicious_counts(df: DataFrame, limits: dict[str, tuple[float, float]], by: Sequence[str] = ()) -> DataFrame:
    """Per group, how many values of each column are known but outside its limits."""
    return df.groupBy(*by).agg(
        *[count_if(~F.col(c).between(low, high)).alias(f"{c}_out_of_range") for c, (low, high) in limits.items()]
    )
