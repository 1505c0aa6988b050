"""Chunks, pages and provenance of an ingest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart.operators.dedup import first_per_key


def _checked(chunk_days: int, start: Column, end: Column) -> Column:
    """``start``, failing the job where the range is empty or reversed."""
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
    return F.when(end > start, start).otherwise(F.raise_error(F.lit("range end must be after its start")))


def time_chunks(ranges: DataFrame, start: str, end: str, chunk_days: int) -> DataFrame:
    """Half-open chunks [chunk_start, chunk_end) of at most ``chunk_days`` days for every row."""
    first = _checked(chunk_days, F.col(start), F.col(end))
    step = F.expr(f"INTERVAL '{int(chunk_days)}' DAY")
    return (
        ranges.withColumn("chunk_start", F.explode(F.sequence(first, F.col(end), step)))
        .where(F.col("chunk_start") < F.col(end))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end)))
    )


def date_chunks(ranges: DataFrame, start: str, end: str, chunk_days: int) -> DataFrame:
    """Chunks of whole days, both ends included; an end at midnight does not open its day."""
    first = F.to_date(_checked(chunk_days, F.col(start), F.col(end)))
    last = F.to_date(F.col(end) - F.expr("INTERVAL 1 SECOND"))
    step = F.expr(f"INTERVAL '{int(chunk_days)}' DAY")
    return ranges.withColumn("chunk_start", F.explode(F.sequence(first, last, step))).withColumn(
        "chunk_end", F.least(F.date_add("chunk_start", chunk_days - 1), last)
    )


def chunk_number(when: Column, start: Column, chunk_days: int) -> Column:
    """Which half-open chunk of a range starting at ``start`` a moment falls into, from 0."""
    seconds = F.unix_micros(when.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(seconds / F.lit(chunk_days * 86_400_000_000)).cast("int")


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All pages as one bag; columns meet by name."""
    return reduce(lambda a, b: a.unionByName(b), pages)


def keep_first(rows: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """First arrival of every key over all chunks and pages."""
    return first_per_key(rows, key, list(arrival))


def ingest_audit(rows: DataFrame, key: Sequence[str], chunk: str) -> DataFrame:
    """Per chunk, rows received and rows whose key no earlier chunk had brought.

    Both counts combine on the map side, so a key that is delivered over and over sends one row
    per map task.
    """
    per_key = rows.groupBy(*key).agg(F.min(chunk).alias(chunk))
    added = per_key.groupBy(chunk).agg(F.count(F.lit(1)).alias("added_rows_count"))
    received = rows.groupBy(chunk).agg(F.count(F.lit(1)).alias("rows_count"))
    return received.join(added, chunk, "left").select(
        chunk, "rows_count", F.coalesce("added_rows_count", F.lit(0)).alias("added_rows_count")
    )


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary``, or ``fallback`` when it is empty, with ``source`` telling which.

    One plan: the emptiness test is an uncorrelated EXISTS that stops at the first row.
    """
    unused = ~primary.exists()
    return primary.withColumn("source", F.lit("parsed")).unionByName(
        fallback.where(unused).withColumn("source", F.lit("fallback"))
    )
