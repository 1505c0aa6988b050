"""Unusual readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart.functions.derive import count_if
from hazemart.operators.joins import join_on_keys
from hazemart.operators.ordered import exact_quantiles, previous_value


def _approximate(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], accuracy: int):
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, q, accuracy).alias(name) for name, q in quantiles.items()]
    )


def iqr_outliers(
    df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5, accuracy: int | None = None
) -> DataFrame:
    """Every row with the quartile fence of its group and ``is_outlier``.

    Quartiles are exact; ``accuracy`` switches to Spark's sketch.
    """
    wanted = {"q1": 0.25, "q3": 0.75}
    if accuracy is None:
        quartiles = exact_quantiles(df, keys, value, wanted)
    else:
        quartiles = _approximate(df, keys, value, wanted, accuracy)
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        *keys, (F.col("q1") - factor * spread).alias("lower_fence"), (F.col("q3") + factor * spread).alias("upper_fence")
    )
    outside = ~F.col(value).between(F.col("lower_fence"), F.col("upper_fence"))
    return join_on_keys(df, fences, keys, "left").withColumn("is_outlier", F.coalesce(outside, F.lit(False)))


def median_deviation(
    df: DataFrame, keys: Sequence[str], value: str, accuracy: int | None = None
) -> DataFrame:
    """Every row with the median of its group (site and hour of day, say) and the distance to it."""
    if accuracy is None:
        medians = exact_quantiles(df, keys, value, {"median_value": 0.5})
    else:
        medians = _approximate(df, keys, value, {"median_value": 0.5}, accuracy)
    return join_on_keys(df, medians, keys, "left").withColumn("deviation", F.col(value) - F.col("median_value"))


def exceedance_by_day(df: DataFrame, site: str, when: str, value: str, threshold: float) -> DataFrame:
    return df.groupBy(site, F.to_date(when).alias("date")).agg(
        F.count(F.lit(1)).alias("row_count"), count_if(F.col(value) > threshold).alias("exceedance_count")
    )


def exceedance_sites(by_day: DataFrame, site: str) -> DataFrame:
    """Sites with their exceedances and the number of days that had any."""
    return by_day.groupBy(site).agg(
        F.sum("exceedance_count").alias("exceedance_count"),
        count_if(F.col("exceedance_count") > 0).alias("exceedance_days"),
        F.count(F.lit(1)).alias("observed_days"),
    )


def jumps(
    df: DataFrame, keys: Sequence[str], when: str, value: str, threshold: float, tie_break: Sequence[str] = (),
    piece_unit: str = "DAY",
) -> DataFrame:
    """Every row with the previous value of its key and ``is_jump`` for a change above ``threshold``.

    Rows of a key are sorted per ``piece_unit``: days suit hourly readings, denser feeds take minutes.
    """
    with_previous = previous_value(
        df, keys, [when, *tie_break], value, F.date_trunc(piece_unit, when), "previous_value"
    )
    change = F.col(value) - F.col("previous_value")
    return with_previous.withColumns(
        {"change": change, "is_jump": F.coalesce(F.abs(change) > threshold, F.lit(False))}
    )
