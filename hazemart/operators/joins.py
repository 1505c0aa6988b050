"""Row-preserving joins.

There are no broadcast hints: the planner compares the size of the small side with its threshold
and otherwise sorts and merges, where AQE splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_context(facts: DataFrame, context: DataFrame, on: str = "timestamp") -> DataFrame:
    """Every fact with the context row of its hour; ``context`` must be unique in ``on``."""
    return facts.join(context, on, "left")


def attach_names(facts: DataFrame, dimension: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    return facts.join(dimension.select(key, *names), key, "left")


def mark_existing(facts: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Every fact with ``flag`` telling whether its key occurs in ``keys``."""
    marks = keys.select(*on).distinct().withColumn(flag, F.lit(True))
    return facts.join(marks, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys meet, the columns of ``keys`` kept once."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])
