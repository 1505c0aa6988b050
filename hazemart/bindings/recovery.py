"""What is left after something broke: publications, resumed and reset streams, repeated batches, late updates of the lake.

Every query breaks its run on purpose and is checked against the SQL of a run that was not broken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.marts import ALL_ROLES, SQL_DAILY
from hazemart.bindings.registry import query
from hazemart.bindings.streams import SQL_MESSAGES, SQL_WINDOWS, as_messages
from hazemart.bindings.tables import with_roles
from hazemart.config import StreamSettings
from hazemart.plans import marts, views
from hazemart.session import scratch_path
from hazemart.sources import publication, sinks, streams
from hazemart.streaming import events as ev
from hazemart.streaming import run

PARTS = 4
#: parts arrive in no order of time, so nothing may be too late within a quarter
PATIENT = replace(StreamSettings(), watermark="90 days")


def inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of all messages that comes in about ``PARTS`` micro-batches, each with events of the whole month."""
    folder = scratch_path(spark, "inbox")
    messages = as_messages(t.events(spark, sf_dir), t.sites(spark, sf_dir))
    for part in range(PARTS):
        mine = F.pmod(F.xxhash64("value"), F.lit(PARTS)) == part
        messages.where(mine).write.mode("append").text(folder)
    count = len(spark.read.text(folder).inputFiles())
    return streams.text_events(spark, folder, files_per_trigger=max(1, count // PARTS))


def broken_once(sink: Callable[[DataFrame, int], None], at: int, after: bool = True) -> Callable[[DataFrame, int], None]:
    """``sink`` that fails in its first run of micro-batch ``at``, before or after it wrote."""
    failed = []

    def write(batch: DataFrame, batch_id: int) -> None:
        breaks = batch_id == at and not failed
        if breaks:
            failed.append(batch_id)
        if after or not breaks:
            sink(batch, batch_id)
        if breaks:
            raise RuntimeError(f"broken in micro-batch {batch_id}")

    return write


def until_it_breaks(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, settings: StreamSettings) -> None:
    try:
        run.start(df, sink, checkpoint, settings).awaitTermination()
    except StreamingQueryException as failure:
        if "broken in micro-batch" not in str(failure):
            raise
    else:
        raise AssertionError("the run was to break")


def counted_windows(messages: DataFrame, clamp: bool = True) -> DataFrame:
    return ev.window_aggregates(ev.valid_events(ev.parse_events(messages, clamp=clamp)), PATIENT)


@query(
    "publish_set",
    with_roles(*ALL_ROLES, SQL_DAILY, select="""
    SELECT 'daily' AS table_name, CAST("date" AS VARCHAR) AS key, site_id, rows_count AS n FROM daily
    UNION ALL SELECT 'sites', max(site_name), site_id, CAST(sum(rows_count) AS BIGINT) FROM daily JOIN sites USING (site_id) GROUP BY site_id"""),
)
def _publish_set(spark, sf_dir):
    """A second publication with other rows breaks in its second table, a third one in what is derived; the first is read back whole."""
    location = scratch_path(spark, "serving-set")
    hourly, sites = t.hourly(spark, sf_dir), t.sites(spark, sf_dir)
    daily = marts.daily_mart(hourly).select("date", "site_id", "rows_count")

    def per_site(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {"per_site": views.named(stored["daily"].groupBy("site_id").agg(F.sum("rows_count").alias("n")), stored["sites"])}

    def breaking(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        lost = F.when(F.col("rows_count") >= 0, F.raise_error(F.lit("an executor gave up"))).otherwise(F.col("rows_count"))
        return {"per_site": stored["daily"].withColumn("n", lost.cast("long"))}

    first = publication.publish_set(spark, location, {"daily": daily, "sites": sites}, per_site)
    halved = daily.withColumn("rows_count", F.col("rows_count") * 2)
    for other, derived in (
        ({"daily": halved, "sites": sites.withColumn("site_name", F.raise_error(F.lit("an executor gave up")).cast("string"))}, per_site),
        ({"daily": halved, "sites": sites}, breaking),
    ):
        try:
            publication.publish_set(spark, location, other, derived)
        except Exception as failure:
            if "an executor gave up" not in str(failure):
                raise
        if publication.current_version(spark, location) != first:
            raise AssertionError("a broken publication was seen")
    found = publication.current_set(spark, location)
    days = found["daily"].select(F.lit("daily").alias("table_name"), F.col("date").cast("string").alias("key"), "site_id", F.col("rows_count").alias("n"))
    known = found["per_site"].where(F.col("site_name").isNotNull())
    return days.unionByName(known.select(F.lit("sites").alias("table_name"), F.col("site_name").alias("key"), "site_id", "n"))


@query("stream_resume", with_roles(SQL_WINDOWS, select="SELECT * FROM windows"))
def _stream_resume(spark, sf_dir):
    """Two micro-batches with wrong settings, reset; two more, broken after the second was written; then the rest from the same progress."""
    messages = inbox(spark, sf_dir)
    path, progress = scratch_path(spark, "resumed"), scratch_path(spark, "progress")
    sink = sinks.parquet_batch_sink(path)
    wrong = counted_windows(messages.where(F.length("value") % 2 == 0), clamp=False)
    until_it_breaks(wrong, broken_once(sink, at=1), progress, PATIENT)
    run.reset(spark, progress, path)
    counted = counted_windows(messages)
    until_it_breaks(counted, broken_once(sink, at=1), progress, PATIENT)
    run.start(counted, sink, progress, PATIENT).awaitTermination()
    return run.latest_windows(spark, path)


@query(
    "stream_fan_out_replay",
    with_roles(SQL_MESSAGES, select="""
    SELECT sink, site_id, count(*) AS n FROM valid, (VALUES ('before'), ('broken'), ('behind')) AS s(sink) GROUP BY sink, site_id"""),
)
def _stream_fan_out_replay(spark, sf_dir):
    """Three sinks that only append; the second fails once in a micro-batch, which is then run again without the first."""
    path, progress = scratch_path(spark, "fan-out"), scratch_path(spark, "progress")

    def append(name: str) -> Callable[[DataFrame, int], None]:
        return lambda batch, batch_id: batch.withColumn("sink", F.lit(name)).write.mode("append").parquet(f"{path}/{name}")

    outputs = {"before": append("before"), "broken": broken_once(append("broken"), at=1, after=False), "behind": append("behind")}
    fan = sinks.fan_out(outputs, sinks.Ledger(spark, f"{path}/ledger"))
    valid = ev.valid_events(ev.parse_events(inbox(spark, sf_dir), clamp=True)).select("site_id")
    appended = replace(StreamSettings(), output_mode="append")
    until_it_breaks(valid, fan, progress, appended)
    run.start(valid, fan, progress, appended).awaitTermination()
    return spark.read.parquet(*[f"{path}/{name}" for name in outputs]).groupBy("sink", "site_id").agg(F.count(F.lit(1)).alias("n"))


@query("stream_lake_views", with_roles(SQL_WINDOWS, select="SELECT * FROM windows"))
def _stream_lake_views(spark, sf_dir):
    """The windows of the lake after several micro-batches that all update the same days, one of them twice, and a compaction."""
    path, progress = scratch_path(spark, "lake"), scratch_path(spark, "progress")
    sink = sinks.lake_window_sink(path, days_at_once=10)
    counted = counted_windows(inbox(spark, sf_dir))
    until_it_breaks(counted, broken_once(sink, at=2), progress, PATIENT)
    run.start(counted, sink, progress, PATIENT).awaitTermination()
    sinks.compact_days(spark, path, small_files=0)
    windows = spark.read.parquet(path)
    return views.stream_views(windows)["v_stream_aggregates"].drop("batch_id", "day")


@query(
    "ingest_stamp",
    with_roles(SQL_MESSAGES, select="SELECT site_id, count(*) AS n, count(*) AS stamped, 0::BIGINT AS early FROM messages GROUP BY site_id"),
)
def _ingest_stamp(spark, sf_dir):
    """Every event carries the time it was taken in, which is not before the run began."""
    began = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    raw = t.raw_readings(spark, sf_dir).withColumn("site_id", F.regexp_replace("site_id", r"\.0$", ""))
    stamp = F.to_timestamp("ingest_time")
    return ev.build_events(raw, t.sites(spark, sf_dir)).groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(stamp).alias("stamped"), F.count_if(stamp < F.lit(began)).alias("early")
    )
