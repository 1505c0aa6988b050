"""Row-wise derived columns: clamps, flags, buckets, calendar parts, fills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clamp(value: Column, low: float, high: float) -> Column:
    """Null outside [low, high]. NaN sorts above every number, so it falls out too."""
    return F.when(value.between(low, high), value)


def clamp_columns(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({name: clamp(F.col(name), *bounds) for name, bounds in limits.items()})


def calendar_parts(when: Column, month: bool = True) -> dict[str, Column]:
    parts = {"date": F.to_date(when), "hour": F.hour(when)}
    if month:
        parts["month"] = F.month(when)
    return parts


def above_any(thresholds: dict[str, float]) -> Column:
    """True when any column exceeds its threshold; an unknown value counts as not exceeding."""
    tests = [F.coalesce(F.col(name) > limit, F.lit(False)) for name, limit in thresholds.items()]
    return reduce(Column.__or__, tests)


def missing_any(names: list[str] | tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.col(name).isNull() for name in names])


def bucket(value: Column, breaks, top: str, unknown: str) -> Column:
    """Label of the first upper break above ``value``; ``breaks`` are (label, upper) pairs."""
    label = F.when(value.isNull(), F.lit(unknown))
    for name, upper in breaks:
        label = label.when(value < upper, F.lit(name))
    return label.otherwise(F.lit(top))


def positive(value: Column) -> Column:
    return F.coalesce(value > 0, F.lit(False))


def fill(defaults: dict[str, object]) -> dict[str, Column]:
    return {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}


def severity(present: Column, level: Column) -> Column:
    """0 for no notice, 1 for a general one, 2 to 4 for the declared levels."""
    return present + level


def count_if(flag: Column) -> Column:
    """Number of rows where ``flag`` is true, 0 when there are none; null flags do not count."""
    return F.sum(F.when(flag, 1).otherwise(0))


def share_of(flag: Column) -> Column:
    return F.avg(F.when(flag, 1.0).otherwise(0.0))
