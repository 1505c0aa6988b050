"""Where results go. Every write is a distributed one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.session import scratch_path
from hazemart.sources import files

#: days merged or compacted by one job
DAYS_AT_ONCE = 64
#: files of one day beyond which it is compacted
SMALL_FILES = 8


def write_staging(df: DataFrame, path: str, partition: str | None = "date") -> None:
    """Parquet layer. With ``partition`` only the days present in ``df`` are replaced.

    Rows are rebalanced by day before the write: AQE joins small days to one file and splits a
    large day into files of the advisory partition size.
    """
    if partition:
        (
            df.hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    else:
        df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_json_snapshot(rows: DataFrame, audit: DataFrame, path: str) -> None:
    """Rows as JSON lines beside the audit of the run that brought them."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/rows")
    audit.write.mode("overwrite").json(f"{path}/requests")


def key_value(df: DataFrame, key: str, ignore_nulls: bool = True) -> DataFrame:
    """Message frame: the key as text and the whole row as JSON."""
    options = {"ignoreNullFields": str(ignore_nulls).lower()}
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*"), options).alias("value"))


def kafka_sink(servers: str, topic: str, key: str = "site_id") -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        key_value(batch, key).write.format("kafka").options(
            **{"kafka.bootstrap.servers": servers, "topic": topic}
        ).save()

    return write


def jdbc_snapshot_sink(url: str, table: str, **options: str) -> Callable[[DataFrame, int], None]:
    """Replaces the rows and keeps the table definition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options).mode("overwrite").save()

    return write


def parquet_batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """One folder per micro-batch; a batch that is run again replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def stored_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date | None]) -> DataFrame:
    """The rows of some days of a folder partitioned by ``day``; only their partitions are listed and read."""
    known = [d for d in days if d is not None]
    wanted = F.col("day").isin(known) if known else F.lit(False)
    if len(known) < len(days):
        wanted = wanted | F.col("day").isNull()
    return spark.read.schema(schema).parquet(path).where(wanted)


def lake_window_sink(
    path: str, key: Sequence[str] = ("window_start", "site_id", "site_name"), when: str = "window_start", days_at_once: int = DAYS_AT_ONCE
) -> Callable[[DataFrame, int], None]:
    """One row per ``key`` below ``path``, by day; the row of the latest micro-batch wins.

    A micro-batch reads and replaces only the days it touches, named as literals, and running one again
    changes nothing. Many days are merged in portions of ``days_at_once``. What is written on the way is removed with each portion.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived, merged = scratch_path(spark, "arrived"), scratch_path(spark, "merged")
        rows = batch.withColumns({"batch_id": F.lit(batch_id).cast("long"), "day": F.to_date(when)})
        try:
            rows.write.parquet(arrived)
            fresh = spark.read.schema(rows.schema).parquet(arrived)
            # at most one value for each day of the calendar
            days = [r.day for r in fresh.select("day").distinct().orderBy("day").collect()]
            for first in range(0, len(days), days_at_once):
                some = days[first : first + days_at_once]
                both = stored_days(spark, arrived, rows.schema, some)
                if files.exists(spark, path):
                    both = both.unionByName(stored_days(spark, path, rows.schema, some))
                newest = Window.partitionBy(*key).orderBy(F.col("batch_id").desc())
                latest = both.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
                # the days that are replaced are read for the merge, so that is finished first
                latest.write.mode("overwrite").parquet(merged)
                write_staging(spark.read.schema(rows.schema).parquet(merged), path, "day")
        finally:
            files.remove(spark, arrived)
            files.remove(spark, merged)

    return write


def compact_days(spark: SparkSession, path: str, small_files: int = SMALL_FILES, days_at_once: int = DAYS_AT_ONCE) -> list[date | None]:
    """Rewrites the days of a lake that lie in more than ``small_files`` files each; their rows stay as they are.

    Days are copied to scratch before they are replaced, portion by portion; a day that is interrupted is whole, old or new.
    """
    stored = spark.read.parquet(path)
    crowded = stored.select("day", "_metadata.file_path").groupBy("day").agg(F.count_distinct("file_path").alias("files"))
    days = [r.day for r in crowded.where(F.col("files") > small_files).orderBy("day").collect()]
    for first in range(0, len(days), days_at_once):
        copy = scratch_path(spark, "compacted")
        try:
            stored_days(spark, path, stored.schema, days[first : first + days_at_once]).write.parquet(copy)
            write_staging(spark.read.schema(stored.schema).parquet(copy), path, "day")
        finally:
            files.remove(spark, copy)
    return days


def top_rows(df: DataFrame, order: Sequence[str] = ("window_start", "site_id"), n: int = 30) -> DataFrame:
    return df.orderBy(*order).limit(n)


def console_sink(order: Sequence[str] = ("window_start", "site_id"), n: int = 30) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}: {batch.count()} aggregates", flush=True)
        top_rows(batch, order, n).show(n, truncate=False)

    return write


class Ledger:
    """Which sink has taken which micro-batch, as one small file each below ``path``.

    Belongs to one checkpoint and is reset with it. Only the last batch can be run again, so the entries of older ones are removed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def has(self, batch_id: int, sink: str) -> bool:
        return files.exists(self.spark, f"{self.path}/{batch_id}/{sink}")

    def enter(self, batch_id: int, sink: str) -> None:
        files.claim(self.spark, f"{self.path}/{batch_id}/{sink}")

    def forget(self, batch_id: int) -> None:
        for name in files.names(self.spark, self.path):
            if int(name) < batch_id:
                files.remove(self.spark, f"{self.path}/{name}")


def fan_out(
    sinks: Sequence[Callable[[DataFrame, int], None]] | dict[str, Callable[[DataFrame, int], None]], ledger: Ledger | None = None
) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks, computed once.

    With a ``ledger`` and named sinks a batch that is run again, because a later sink failed or the driver was lost, goes only
    to the sinks that have not taken it. A sink that was lost between its end and its entry takes the batch once more.
    """
    named = dict(sinks) if isinstance(sinks, dict) else {str(n): sink for n, sink in enumerate(sinks)}

    def write(batch: DataFrame, batch_id: int) -> None:
        todo = {name: sink for name, sink in named.items() if ledger is None or not ledger.has(batch_id, name)}
        if todo:
            batch.persist()
            try:
                for name, sink in todo.items():
                    sink(batch, batch_id)
                    if ledger is not None:
                        ledger.enter(batch_id, name)
            finally:
                batch.unpersist()
        if ledger is not None:
            ledger.forget(batch_id)

    return write
