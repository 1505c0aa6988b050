"""Deduplication with a declared survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Written as ``row_number() = 1`` so that Spark keeps one row per key and map task
    (WindowGroupLimit) before the shuffle: a key holding a third of all rows sends one row per task.
    Make ``order`` total, else equal rows compete.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(sequence).desc()])


def strongest_per_key(
    df: DataFrame, keys: Sequence[str], strength: str, tie_break: Sequence[str]
) -> DataFrame:
    """The row of highest ``strength`` per key, ties broken by ``tie_break`` ascending."""
    return first_per_key(df, keys, [F.col(strength).desc(), *[F.col(c).asc() for c in tie_break]])
