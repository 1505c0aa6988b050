"""Half-open intervals and their grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS_PER_PIECE = 24 * 31
#: steps of the pieces that are counted before they are expanded
STEPS_PER_COUNT = 32


def valid_intervals(df: DataFrame, start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Rows with both ends present and end after start (a null end fails the comparison)."""
    return df.where(F.col(end) > F.col(start))


def _pieces(df: DataFrame, first: Column, end: str, unit: str, steps: int) -> DataFrame:
    """Every [first, end) cut into [_piece, _stop) of at most ``steps`` steps."""
    step = F.expr(f"INTERVAL '{int(steps)}' {unit}")
    return (
        df.withColumn("_piece", F.explode(F.sequence(first, F.col(end), step)))
        .where(F.col("_piece") < F.col(end))
        .withColumn("_stop", F.least(F.col("_piece") + step, F.col(end)))
    )


def expand_intervals(
    df: DataFrame,
    start: str = "period_start",
    end: str = "period_end",
    slot: str = "timestamp",
    unit: str = "HOUR",
    align: bool = False,
    steps_per_piece: int = STEPS_PER_PIECE,
) -> DataFrame:
    """One row per step of [start, end).

    The grid starts at ``start`` itself, or at its full unit with ``align``. An interval is first
    cut into pieces of ``steps_per_piece`` steps and then into steps, so no array grows with the
    length of an interval and no length limit is needed.
    """
    first = F.date_trunc(unit, F.col(start)) if align else F.col(start)
    step = F.expr(f"INTERVAL '1' {unit}")
    return (
        _pieces(valid_intervals(df, start, end), first, end, unit, steps_per_piece)
        .withColumn(slot, F.explode(F.sequence(F.col("_piece"), F.col("_stop"), step)))
        .where(F.col(slot) < F.col("_stop"))
        .drop("_piece", "_stop")
    )


def count_steps(
    df: DataFrame, start: str = "period_start", end: str = "period_end", slot: str = "timestamp", unit: str = "HOUR", count: str = "rows_count"
) -> DataFrame:
    """(``slot``, ``count``): how many of the intervals hold each step of their grids.

    Equals the counts of :func:`expand_intervals`, without a row per interval and step: equal intervals are counted first, then
    cut into short pieces, and equal pieces are counted before they are expanded. All but the last piece of an interval
    depend on its start alone. For units of fixed length; steps of months drift with the day they start from.
    """
    equal = valid_intervals(df, start, end).groupBy(start, end).agg(F.count(F.lit(1)).alias("_n"))
    pieces = _pieces(equal, F.col(start), end, unit, STEPS_PER_COUNT).groupBy("_piece", "_stop").agg(F.sum("_n").alias("_n"))
    steps = expand_intervals(pieces.select(F.col("_piece").alias(start), F.col("_stop").alias(end), "_n"), start, end, slot, unit)
    return steps.groupBy(slot).agg(F.sum("_n").alias(count))
