"""Order statistics that never gather a group in one task.

A group (or the whole table) is cut into slices of the value range. Slice totals are small, so
their running sum is cheap; inside a slice the running sum is an ordinary window. Hot groups and
tables without a key are thereby spread over many tasks, and the results are exact: the sketch
that suggests the slice edges only decides how even the slices are. Counts per value and the edges
are written to the shared folder once and read by the steps that follow; a merged sketch depends on
the order in which its parts arrive, so edges that were found twice could differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazemart.operators.joins import join_on_keys
from hazemart.session import settled

SLICES = 1024


def _with_slice(df: DataFrame, keys: Sequence[str], value: str, slices: int) -> DataFrame:
    """Add ``_slice``, the number of edges below ``value``, rising with it within a group.

    Edges are found in two steps, among every ``width``-th edge and then among the ``width`` edges
    that follow, so a row is compared with few of them.
    """
    width = max(1, int(slices**0.5))
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    sketch = F.array_distinct(F.percentile_approx(value, shares, F.lit(slices * 5)))
    # every width-th edge is picked once per group, before the edges meet the rows
    found = df.groupBy(*keys).agg(sketch.alias("_edges"))
    found = settled(found.withColumn("_marks", F.filter("_edges", lambda edge, i: (i + 1) % width == 0)), "edges")
    if keys:
        placed = join_on_keys(df, found, keys)
    else:
        both = found.select(F.struct("_edges", "_marks").alias("both"))
        placed = df.withColumn("_both", both.scalar()).select(*df.columns, "_both._edges", "_both._marks")

    def below(edges: Column) -> Column:
        return F.coalesce(F.size(F.filter(edges, lambda edge: edge < F.col(value))), F.lit(0))

    return (
        placed.withColumn("_first", below(F.col("_marks")) * width)
        .withColumn("_slice", F.col("_first") + below(F.slice("_edges", F.col("_first") + 1, width)))
        .drop("_edges", "_marks", "_first")
    )


def running_before(
    df: DataFrame, keys: Sequence[str], value: str, amount: str, result: str, slices: int = SLICES,
) -> DataFrame:
    """Add ``result``: the sum of ``amount`` over rows of the same group with a smaller ``value``.

    ``df`` holds each (keys, value) once. Windows without a key run over at most ``slices`` rows.
    """
    placed = _with_slice(settled(df, "running"), keys, value, slices)
    at = [*keys, "_slice"]
    earlier_slices = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*at).agg(F.sum(amount).alias("_total"))
    # what lies below a slice enters it as a row of its own, ahead of all others: no join is needed
    bases = totals.select(
        *at,
        F.coalesce(F.sum("_total").over(earlier_slices), F.lit(0)).alias(amount),
        F.lit(True).alias("_is_base"),
    )
    rows = placed.withColumn("_is_base", F.lit(False)).unionByName(bases, allowMissingColumns=True)
    in_order = (
        Window.partitionBy(*at).orderBy(F.col("_is_base").desc(), value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.withColumn(result, F.sum(amount).over(in_order)).where(~F.col("_is_base")).drop("_slice", "_is_base")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], slices: int = SLICES,
) -> DataFrame:
    """Interpolated quantiles per group, one column per entry of ``quantiles``.

    Equal values are counted before anything is ordered, and only slices that hold a wanted rank
    are sorted. Nulls are ignored.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = _with_slice(settled(counts, "counts"), keys, value, slices)
    at = [*keys, "_slice"]
    ordered = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy(*at).agg(F.sum("_n").alias("_in_slice"))
        .withColumn("_base", F.coalesce(F.sum("_in_slice").over(ordered), F.lit(0)))
        .withColumn("_all", F.sum("_in_slice").over(Window.partitionBy(*keys)))
    )

    position = {name: F.lit(float(q)) * (F.col("_all") - 1) for name, q in quantiles.items()}
    lower = {name: F.floor(p) for name, p in position.items()}
    upper = {name: F.ceil(p) for name, p in position.items()}

    def holds(rank: Column, base: str, size: str) -> Column:
        return (rank >= F.col(base)) & (rank < F.col(base) + F.col(size))

    wanted = F.lit(False)
    for name in quantiles:
        wanted = wanted | holds(lower[name], "_base", "_in_slice") | holds(upper[name], "_base", "_in_slice")

    before = Window.partitionBy(*at).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = join_on_keys(placed, bases.where(wanted), at).withColumn(
        "_before", F.col("_base") + F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    picks = []
    for name in quantiles:
        picks += [
            F.max(F.when(holds(lower[name], "_before", "_n"), F.col(value))).alias(f"_low_{name}"),
            F.max(F.when(holds(upper[name], "_before", "_n"), F.col(value))).alias(f"_high_{name}"),
            F.max(position[name] - lower[name]).alias(f"_part_{name}"),
        ]
    picked = ranked.groupBy(*keys).agg(*picks)
    return picked.select(
        *keys,
        *[
            (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in quantiles
        ],
    )


def competition_ranks(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """``rank() over (order by score desc)`` without a single-partition window; null scores last.

    ``scores`` maps each result column to its score column.
    """
    base = rows = settled(df, "ranked")
    for result, score in scores.items():
        counts = base.where(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("_rows"))
        falling = counts.withColumn("_falling", -F.col(score))
        ahead = running_before(falling, [], "_falling", "_rows", "_ahead").select(score, "_ahead")
        known = base.agg(F.count(score).alias("n")).scalar()
        rows = (
            rows.join(ahead, score, "left")
            .withColumn(result, (F.coalesce(F.col("_ahead"), known) + 1).cast("int"))
            .drop("_ahead")
        )
    return rows


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, piece: Column, result: str
) -> DataFrame:
    """``lag(value)`` per key in ``order``, with long histories cut by ``piece``.

    ``piece`` is a coarsening of the first order column, such as its day or its minute, fine enough
    that a task can sort one. Each piece is sorted on its own and takes the last value of the
    nearest earlier piece as its start.
    """
    cut = df.withColumns({"_piece": piece, "_held": F.struct(F.col(value).alias("v")), "_is_carried": F.lit(False)})
    at = [*keys, "_piece"]
    ends = cut.groupBy(*at).agg(F.max_by("_held", F.struct(*order)).alias("_end"))
    previous_end = F.lag("_end").over(Window.partitionBy(*keys).orderBy("_piece"))
    # the carried value enters its piece as a first row, so rows are shuffled once and never joined
    carried = ends.select(*at, previous_end.alias("_held"), F.lit(True).alias("_is_carried"))
    in_order = Window.partitionBy(*at).orderBy(F.col("_is_carried").desc(), *order)
    return (
        cut.unionByName(carried, allowMissingColumns=True)
        .withColumn(result, F.lag("_held").over(in_order)["v"])
        .where(~F.col("_is_carried"))
        .drop("_piece", "_held", "_is_carried")
    )
