"""Streams: parsing, modes, late and repeated events, sinks, progress."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hazemart.config import StreamSettings
from hazemart.session import scratch_path
from hazemart.sources import sinks, streams
from hazemart.streaming import events as ev
from hazemart.streaming import run


def message(site, time, aqi="10", **more):
    return json.dumps({"site_id": site, "site_name": "s", "event_time": f"2026-04-01 {time}" if time else None, "aqi": aqi, **more})


def deliver(spark, folder, *messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(folder)


def parsed(spark, *messages, **options):
    return ev.parse_events(spark.createDataFrame([(m,) for m in messages], "value string"), **options)


def test_only_valid_events_pass(spark):
    messages = [
        "{oops", "", message(1, "00:00:00", None), message(1, "00:00:00", "1000.1"), message(1, "00:00:00", "-0,1"), message(None, "00:00:00"),
        message(1, None), message(1, "25:00:00"), message("7", "00:00:00"), message(8, "00:00:00", "1000"), message(9, "00:00:00", "0,5"),
    ]
    found = ev.valid_events(parsed(spark, *messages)).collect()
    assert sorted((r.site_id, r.aqi) for r in found) == [(7, 10.0), (8, 1000.0), (9, 0.5)]


def test_clamp_is_an_option(spark):
    messages = [message(1, "00:00:00", pm25="NaN"), message(2, "00:00:00", pm10="9999")]
    assert [r.is_pollution_peak for r in parsed(spark, *messages).orderBy("site_id").collect()] == [True, True]
    assert [r.is_pollution_peak for r in parsed(spark, *messages, clamp=True).orderBy("site_id").collect()] == [False, False]


def counts(spark, path, mode):
    return {(r.window_start.hour, r.site_id): r.sample_count for r in run.latest_windows(spark, path, mode).collect()}


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("complete", {(0, 1): 2, (12, 1): 2, (15, 1): 1}), ("update", {(0, 1): 1, (12, 1): 2, (15, 1): 1}), ("append", {(0, 1): 1, (12, 1): 2}),
    ],
)
def test_late_events_by_mode(spark, mode, expected):
    """The third delivery brings an event far behind the watermark."""
    folder, path = scratch_path(spark, "inbox"), scratch_path(spark, f"out-{mode}")
    settings = replace(StreamSettings(), output_mode=mode)
    deliveries = [
        [message(1, "00:10:00"), message(1, "12:10:00")], [message(1, "12:50:00"), message(1, "15:30:00")], [message(1, "00:20:00")],
    ]
    for batch in deliveries:
        deliver(spark, folder, *batch)
        counted = ev.window_aggregates(ev.valid_events(ev.parse_events(streams.text_events(spark, folder))), settings)
        run.drain_to_parquet(counted, path, settings, checkpoint=f"{path}-progress")
    assert counts(spark, path, mode) == expected


def test_complete_snapshot_equals_batch(spark, rows):
    folder, path = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    messages = [message(s, f"{h:02d}:{m:02d}:00", str(s * h + m), pm25=str(m)) for s in (1, 2) for h in (0, 5) for m in (0, 30, 59)]
    deliver(spark, folder, *messages)
    settings = replace(StreamSettings(), output_mode="complete")
    run.drain_to_parquet(ev.window_aggregates(ev.valid_events(ev.parse_events(streams.text_events(spark, folder))), settings), path, settings)
    batch = ev.window_aggregates(ev.valid_events(parsed(spark, *messages)))
    assert rows(run.latest_windows(spark, path, "complete").select(*ev.WINDOW_COLUMNS)) == rows(batch)


@pytest.mark.parametrize("spread", [False, True])
def test_repeated_delivery_counts_once(spark, spread):
    folder, path = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    settings = replace(StreamSettings(), output_mode="append")
    for batch in ([message(1, "00:10:00", offset=0), message(1, "00:10:00", offset=1), message(2, "00:10:00", offset=2)], [message(1, "00:10:00", offset=3)]):
        deliver(spark, folder, *batch)
        source = streams.text_events(spark, folder).withColumn("offset", F.get_json_object(F.col("value").cast("string"), "$.offset").cast("int"))
        events = ev.valid_events(ev.parse_events(source, carry=["offset"]))
        unique = ev.distinct_events(events, spread=F.pmod("offset", F.lit(2)) if spread else None)
        run.drain_to_parquet(unique.select("site_id", "event_time"), path, settings, checkpoint=f"{path}-progress")
    assert sorted(r.site_id for r in run.latest_windows(spark, path, "append").collect()) == [1, 2]


def test_sinks_share_a_batch_and_progress_resumes(spark):
    folder, progress = scratch_path(spark, "inbox"), scratch_path(spark, "progress")
    seen = {"a": [], "b": []}
    fan = sinks.fan_out([lambda df, i: seen["a"].append(df.count()), lambda df, i: seen["b"].append(df.count()), sinks.console_sink(["site_id"])])
    settings = replace(StreamSettings(), output_mode="append")

    def drain(checkpoint):
        events = ev.valid_events(ev.parse_events(streams.text_events(spark, folder))).select("site_id")
        run.start(events, fan, checkpoint, settings).awaitTermination()

    deliver(spark, folder, message(1, "00:00:00"), message(2, "00:00:00"))
    drain(progress)
    deliver(spark, folder, message(3, "00:00:00"))
    drain(progress)
    assert seen == {"a": [2, 1], "b": [2, 1]}
    drain(scratch_path(spark, "progress"))
    assert sum(seen["a"]) == 6


def test_built_events(spark):
    raw = spark.createDataFrame(
        [(" 7 ", " 2026-04-01 00:00:00 ", "1"), ("7.0", "", " "), (None, None, None)], "site_id string, time string, aqi string"
    ).withColumns({c: F.lit(None).cast("string") for c in ev.VALUE_FIELDS if c != "aqi"})
    sites = spark.createDataFrame([(7, "seven")], "site_id int, site_name string")
    found = ev.build_events(raw, sites)
    assert found.where("ingest_time IS NULL").count() == 0
    assert sorted((str(r.site_id), r.site_name, r.event_time, r.aqi) for r in found.collect() if r.event_time) == [("7", "seven", "2026-04-01 00:00:00", "1")]
    assert found.where("site_id IS NULL AND aqi IS NULL").count() == 2


def test_interval_trigger_keeps_running(spark):
    folder, path = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    settings = replace(StreamSettings(), trigger_interval="1 second")
    deliver(spark, folder, message(1, "00:00:00"))
    counted = ev.window_aggregates(ev.valid_events(ev.parse_events(streams.text_events(spark, folder))), settings)
    query = run.start(counted, sinks.parquet_batch_sink(path), f"{path}-progress", settings, available_now=False)
    try:
        query.processAllAvailable()
        deliver(spark, folder, message(1, "00:30:00"), message(2, "00:00:00"))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert counts(spark, path, "update") == {(0, 1): 2, (0, 2): 1}
