"""Statistics of very large integer files. Spark combines on the map side before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest(numbers: DataFrame, column: str = "value") -> DataFrame:
    return numbers.agg(F.max(column).alias("max_value"))


def mean(numbers: DataFrame, column: str = "value") -> DataFrame:
    """Mean from an exact sum: 38 digits cannot overflow, and no rounding depends on the order."""
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    return numbers.agg((total.cast("double") / F.count(column)).alias("mean_value"))


def distinct(numbers: DataFrame, column: str = "value") -> DataFrame:
    return numbers.select(column).where(F.col(column).isNotNull()).distinct()


def distinct_count(numbers: DataFrame, column: str = "value", relative_error: float | None = None) -> DataFrame:
    """Exact by default; with ``relative_error`` a sketch that needs no shuffle of the values."""
    if relative_error is None:
        count = F.count_distinct(column)
    else:
        count = F.approx_count_distinct(column, relative_error)
    return numbers.agg(count.alias("distinct_count"))
