"""Structured Streaming over the given tables.

The events table is read as a file stream, turned into JSON messages and taken apart again, so the
queries run what a broker's consumer would run. Micro-batches are written as Parquet.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_EVENTS, SQL_SITES, with_roles
from hazemart.config import READING_TIME_FORMAT, StreamSettings
from hazemart.plans import views
from hazemart.session import scratch_path
from hazemart.sources import sinks, streams
from hazemart.streaming import events as ev
from hazemart.streaming import run

SQL_MESSAGES = SQL_EVENTS + SQL_SITES + """
, messages AS (
  SELECT event_id, CASE WHEN k <> 33 THEN CAST(user_id AS INTEGER) END AS site_id, CASE WHEN k <> 33 THEN site_name END AS site_name,
         CASE WHEN k <> 13 THEN hr END AS event_time, ts, k, q,
         CASE k WHEN 17 THEN NULL WHEN 37 THEN -1 ELSE q END AS aqi,
         CASE WHEN k <> 29 THEN q * 0.5 END AS pm10
  FROM ev LEFT JOIN sites ON site_id = user_id)
, valid AS (SELECT * FROM messages WHERE event_time IS NOT NULL AND site_id IS NOT NULL AND aqi BETWEEN 0 AND 1000)
"""

# rounding to one place on the decimal digits of the number, halves away from zero
SQL_ONE_PLACE = "CAST(round(CAST(CAST({0} AS VARCHAR) AS DECIMAL(28, 14)), 1) AS DOUBLE)"

# mean of one-place values to one place, halves up, in whole tenths
SQL_MEAN_OF_TENTHS = """((2 * sum(CAST(round({0} * 10) AS BIGINT)) + count({0})) // (2 * count({0}))) / 10.0::DOUBLE"""

SQL_WINDOWS = SQL_MESSAGES + f"""
, windows AS (
  SELECT event_time AS window_start, event_time + INTERVAL 1 HOUR AS window_end, site_id, site_name,
         {SQL_ONE_PLACE.format("avg(aqi)")} AS avg_aqi, max(aqi) AS max_aqi,
         {SQL_ONE_PLACE.format("avg(CASE WHEN k <> 21 THEN q * 0.25 END)")} AS avg_pm25,
         count(*) FILTER (WHERE aqi > 100 OR (k <> 21 AND q * 0.25 > 35) OR coalesce(pm10 > 150, false)) AS peak_count,
         count(*) AS sample_count
  FROM valid GROUP BY 1, 2, 3, 4)
"""


def as_messages(measured, sites, time_column="hr"):
    """JSON messages of event rows, batch or stream, and when they happened."""
    plain_site = F.regexp_replace("site_id", r"\.0$", "")
    raw = t.as_raw_readings(measured).withColumn("site_id", plain_site)
    if time_column != "hr":
        raw = t.as_raw_readings(measured, time_column).withColumns(
            {
                "site_id": plain_site,
                "time": F.when(F.col("time") == "yesterday", F.col("time")).otherwise(F.date_format(time_column, READING_TIME_FORMAT)),
            }
        )
    return sinks.key_value(ev.build_events(raw, sites, stamp_ingest=False), "site_id").select("value")


def message_stream(spark, sf_dir):
    schema = t.table(spark, sf_dir, "events").schema
    source = t.with_measures(streams.table_events(spark, sf_dir, "events.parquet", schema))
    return as_messages(source, t.sites(spark, sf_dir))


@query(
    "build_events",
    with_roles(SQL_MESSAGES, select="""
    SELECT site_id, site_name, CASE WHEN k = 13 THEN 'yesterday' ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS event_time,
           CASE k WHEN 17 THEN 'n/a' WHEN 37 THEN '-1' ELSE replace(CAST(q AS VARCHAR), '.', ',') END AS aqi,
           CAST(pm10 AS VARCHAR) AS pm10
    FROM messages"""),
)
def _build_events(spark, sf_dir):
    raw = t.raw_readings(spark, sf_dir).withColumn("site_id", F.regexp_replace("site_id", r"\.0$", ""))
    return ev.build_events(raw, t.sites(spark, sf_dir)).select("site_id", "site_name", "event_time", "aqi", "pm10")


@query(
    "stream_parse",
    with_roles(SQL_MESSAGES, select="""
    SELECT site_id, site_name, event_time, aqi, pm10, CASE WHEN k = 21 THEN 'NaN' ELSE CAST(q * 0.25 AS VARCHAR) END AS pm25_text,
           coalesce(aqi > 100, false) OR k = 21 OR q * 0.25 > 35 OR coalesce(pm10 > 150, false) AS is_pollution_peak
    FROM messages"""),
)
def _stream_parse(spark, sf_dir):
    """Without the clamp a NaN passes and raises the peak flag."""
    parsed = ev.parse_events(message_stream(spark, sf_dir))
    path = scratch_path(spark, "stream-parse")
    run.drain_to_parquet(parsed, path, replace(StreamSettings(), output_mode="append"))
    return run.latest_windows(spark, path, "append").select(
        "site_id", "site_name", "event_time", "aqi", "pm10", F.col("pm25").cast("string").alias("pm25_text"), "is_pollution_peak"
    )


@query(
    "stream_filter_valid",
    with_roles(SQL_MESSAGES, select="SELECT site_id, event_time, aqi, pm10 FROM valid"),
)
def _stream_filter_valid(spark, sf_dir):
    valid = ev.valid_events(ev.parse_events(message_stream(spark, sf_dir), clamp=True))
    path = scratch_path(spark, "stream-valid")
    run.drain_to_parquet(valid.select("site_id", "event_time", "aqi", "pm10"), path, replace(StreamSettings(), output_mode="append"))
    return run.latest_windows(spark, path, "append")


def windows(spark, sf_dir, output_mode="update"):
    settings = replace(StreamSettings(), output_mode=output_mode)
    valid = ev.valid_events(ev.parse_events(message_stream(spark, sf_dir), clamp=True), settings.aqi_range)
    path = scratch_path(spark, f"stream-windows-{output_mode}")
    run.drain_to_parquet(ev.window_aggregates(valid, settings), path, settings)
    return run.latest_windows(spark, path, output_mode)


@query("stream_window_agg", with_roles(SQL_WINDOWS, select="SELECT * FROM windows"))
def _stream_window_agg(spark, sf_dir):
    return windows(spark, sf_dir)


@query("stream_window_complete", with_roles(SQL_WINDOWS, select="SELECT * FROM windows"))
def _stream_window_complete(spark, sf_dir):
    return windows(spark, sf_dir, "complete")


@query(
    "stream_site_summary",
    with_roles(SQL_WINDOWS, select=f"""
    SELECT site_id, site_name, count(*) AS window_count, CAST(sum(sample_count) AS BIGINT) AS total_samples,
           {SQL_MEAN_OF_TENTHS.format("avg_aqi")} AS avg_aqi,
           max(max_aqi) AS max_aqi,
           {SQL_MEAN_OF_TENTHS.format("avg_pm25")} AS avg_pm25,
           CAST(sum(peak_count) AS BIGINT) AS peak_count
    FROM windows GROUP BY site_id, site_name"""),
)
def _stream_site_summary(spark, sf_dir):
    return views.stream_site_summary(windows(spark, sf_dir))


@query(
    "stream_top30",
    with_roles(SQL_WINDOWS, select="SELECT * FROM windows ORDER BY window_start, site_id LIMIT 30"),
)
def _stream_top30(spark, sf_dir):
    return sinks.top_rows(windows(spark, sf_dir))


@query(
    "stream_dedup",
    with_roles(SQL_MESSAGES, select="""
    SELECT DISTINCT site_id, date_trunc('second', ts) AS event_time FROM valid"""),
)
def _stream_dedup(spark, sf_dir):
    """Every message delivered three times; copies are reduced per delivery first."""
    schema = t.table(spark, sf_dir, "events").schema
    source = t.with_measures(streams.table_events(spark, sf_dir, "events.parquet", schema))
    messages = as_messages(source, t.sites(spark, sf_dir), "ts")
    copies = messages.withColumn("delivery", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    parsed = ev.parse_events(copies, carry=["delivery"])
    unique = ev.distinct_events(ev.valid_events(parsed), spread=F.col("delivery"))
    path = scratch_path(spark, "stream-dedup")
    run.drain_to_parquet(unique.select("site_id", "event_time"), path, replace(StreamSettings(), output_mode="append"))
    return run.latest_windows(spark, path, "append")


MIDDLE = "2024-01-16 00:00:00"


@query(
    "stream_late_data",
    with_roles(SQL_WINDOWS, select=f"""
    , newest AS (SELECT max(event_time) AS m FROM valid)
    SELECT 'complete' AS mode, window_start, site_id, site_name, sample_count FROM windows
    UNION ALL
    SELECT 'update', window_start, site_id, site_name, sample_count FROM windows WHERE window_start >= TIMESTAMP '{MIDDLE}'
    UNION ALL
    SELECT 'append', window_start, site_id, site_name, sample_count FROM windows, newest
    WHERE window_start >= TIMESTAMP '{MIDDLE}' AND window_end <= m - INTERVAL 2 HOUR"""),
)
def _stream_late_data(spark, sf_dir):
    """The second half of the month arrives first, the first half in a second run on the same progress.

    The first half is then later than the watermark: ``complete`` still counts it, the other modes
    drop it, and ``append`` also holds back the windows the watermark has not passed.
    """
    measured = t.events(spark, sf_dir)
    inbox = scratch_path(spark, "late-inbox")
    is_late = F.col("ts") < F.lit(MIDDLE).cast("timestamp")
    root = scratch_path(spark, "late-windows")
    results = []
    for number, part in enumerate((measured.where(~is_late), measured.where(is_late))):
        as_messages(part, t.sites(spark, sf_dir)).write.mode("append").text(inbox)
        for mode in ("complete", "update", "append"):
            settings = replace(StreamSettings(), output_mode=mode)
            valid = ev.valid_events(ev.parse_events(streams.text_events(spark, inbox), clamp=True))
            counted = ev.window_aggregates(valid, settings)
            run.drain_to_parquet(counted, f"{root}/{mode}", settings, checkpoint=f"{root}/{mode}-progress")
            if number == 1:
                found = run.latest_windows(spark, f"{root}/{mode}", mode)
                results.append(found.select(F.lit(mode).alias("mode"), "window_start", "site_id", "site_name", "sample_count"))
    return results[0].unionByName(results[1]).unionByName(results[2])


SQL_FINAL_COUNTS = """
, unique_events AS (SELECT DISTINCT site_id, site_name, date_trunc('second', ts) AS event_time FROM valid)
, newest AS (SELECT max(event_time) AS m FROM unique_events)
, final_counts AS (
  SELECT date_trunc('hour', event_time) AS window_start, site_id, site_name, count(*) AS sample_count
  FROM unique_events GROUP BY 1, 2, 3)
"""


@query(
    "stream_chain_dedup",
    with_roles(SQL_MESSAGES, SQL_FINAL_COUNTS, select="""
    SELECT f.* FROM final_counts f, newest WHERE window_start + INTERVAL 1 HOUR <= m - INTERVAL 2 HOUR"""),
)
def _stream_chain_dedup(spark, sf_dir):
    """The chain of the stream job: repeated deliveries, counted once, kept by day as one row per window and site.

    ``append`` holds back the windows that the watermark has not passed.
    """
    schema = t.table(spark, sf_dir, "events").schema
    source = t.with_measures(streams.table_events(spark, sf_dir, "events.parquet", schema))
    messages = as_messages(source, t.sites(spark, sf_dir), "ts")
    copies = messages.withColumn("offset", F.explode(F.array(F.lit(5), F.lit(21), F.lit(34))))
    settings = replace(StreamSettings(), output_mode="append")
    path = scratch_path(spark, "stream-lake")
    counted = ev.stream_windows(copies, settings, dedup=True)
    run.start(counted, sinks.lake_window_sink(path), f"{path}-progress", settings).awaitTermination()
    return spark.read.parquet(path).select("window_start", "site_id", "site_name", "sample_count")
