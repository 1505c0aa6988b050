"""What holds when a publication, a batch or a reset does not come to its end."""

import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from hazemart.session import scratch_path, shared_folder
from hazemart.sources import files, publication, sinks
from hazemart.streaming import run


def numbers(spark, n, factor=1):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * factor).alias("v"))


def read(spark, location, name):
    return sorted(tuple(r) for r in publication.current_set(spark, location)[name].collect())


def test_a_set_is_replaced_whole_or_not_at_all(spark):
    location = scratch_path(spark, "set")
    assert publication.current_version(spark, location) is None and publication.current_set(spark, location) == {}
    assert publication.prune(spark, location) == []

    def doubled(stored):
        return {"b": stored["a"].withColumn("v", F.col("v") * 2)}

    assert publication.publish_set(spark, location, {"a": numbers(spark, 3)}, doubled) == 1
    lost = numbers(spark, 3, 7).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publication.publish_set(spark, location, {"a": numbers(spark, 3, 5), "c": lost}, doubled)
    assert publication.current_version(spark, location) == 1 and files.names(spark, location) == ["version=00000001"]
    assert read(spark, location, "b") == [(0, 0), (1, 2), (2, 4)]
    # the place of a version whose driver was lost is not taken again
    draft = publication.Draft(spark, location)
    draft.write("a", numbers(spark, 9))
    assert publication.current_version(spark, location) == 1
    assert publication.publish_set(spark, location, {"a": numbers(spark, 1, 5)}) == 3
    assert read(spark, location, "a") == [(0, 0)] and "b" not in publication.current_set(spark, location)
    with pytest.raises(publication.InvalidSet, match="version 3"):
        draft.finish()
    assert publication.publish_set(spark, location, {"a": numbers(spark, 2, 6)}) == 4
    assert publication.prune(spark, location, keep=2) == [1, 2]
    assert files.names(spark, location) == ["version=00000003", "version=00000004"]


def test_rows_that_are_not_as_declared_are_refused(spark):
    location = scratch_path(spark, "set")
    nested = numbers(spark, 3).withColumn("deep", F.array(F.struct(F.lit(1).alias("x"))))
    publication.publish_set(spark, location, {"a": nested}, must={"a": F.col("v").isNotNull()})
    odd = numbers(spark, 3).withColumn("v", F.when(F.col("k") > 0, F.col("v")))
    with pytest.raises(publication.InvalidSet, match="1 of 3 rows"):
        publication.publish_set(spark, location, {"a": odd, "b": numbers(spark, 2)}, must={"a": F.col("v") >= 0})
    assert publication.current_version(spark, location) == 1 and sorted(tuple(r) for r in publication.current_set(spark, location)["a"].collect()) == sorted(tuple(r) for r in nested.collect())


def test_views_follow_the_current_version(spark):
    location = scratch_path(spark, "set")
    numbers(spark, 1).write.mode("overwrite").saveAsTable("set_a")
    for factor in (1, 10):
        publication.publish_set(spark, location, {"set_a": numbers(spark, 3, factor), "set_b": numbers(spark, 2)})
        publication.point_views(spark, location, {"set_joined": "SELECT a.v FROM {set_a} a JOIN {set_b} b ON a.k = b.k"})
    fresh = spark.newSession()
    assert sorted(r.v for r in fresh.table("set_joined").collect()) == [0, 10]
    assert fresh.table("set_a").count() == 3 and fresh.catalog.getTable("set_a").tableType == "VIEW"


def windows(spark, *rows):
    return spark.createDataFrame(rows, "window_start string, site_id int, site_name string, n long").withColumn(
        "window_start", F.col("window_start").cast("timestamp")
    )


def test_the_lake_reads_only_the_days_a_batch_touches(spark):
    path = scratch_path(spark, "lake")
    before = set(files.names(spark, shared_folder(spark)))
    write = sinks.lake_window_sink(path, days_at_once=2)
    write(windows(spark, *[(f"2026-04-{d:02} 01:00:00", 1, "a", d) for d in range(1, 8)], (None, 2, "b", 0)), 0)
    write(windows(spark, ("2026-04-03 01:00:00", 1, "a", 33), ("2026-04-09 01:00:00", 1, "a", 9), (None, 2, "b", 5)), 1)
    write(windows(spark, ("2026-04-03 01:00:00", 1, "a", 33), ("2026-04-09 01:00:00", 1, "a", 9), (None, 2, "b", 5)), 1)
    found = {(r.day and r.day.day): r.n for r in spark.read.parquet(path).collect()}
    assert found == {1: 1, 2: 2, 3: 33, 4: 4, 5: 5, 6: 6, 7: 7, 9: 9, None: 5}
    assert set(files.names(spark, shared_folder(spark))) - before == {path.rpartition("/")[2]}
    schema = spark.read.parquet(path).schema
    some = sinks.stored_days(spark, path, schema, [date(2026, 4, 3), date(2026, 4, 9)])
    plan = some._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[day#\d+ IN \(2026-04-03,2026-04-09\)\]", plan)
    assert len(some.inputFiles()) >= 2 and some.count() == 2
    assert sinks.stored_days(spark, path, schema, [None]).count() == 1 and sinks.stored_days(spark, path, schema, []).count() == 0


def test_compaction_keeps_rows(spark):
    path = scratch_path(spark, "lake")
    rows = spark.range(400).select(F.expr("date_add(date'2026-04-01', cast(id % 2 as int))").alias("day"), "id")
    for part in range(5):
        rows.where(F.col("id") % 5 == part).repartition(2).write.mode("append").partitionBy("day").parquet(path)
    rows.where("id < 2").select(F.lit(date(2026, 5, 1)).alias("day"), "id").write.mode("append").partitionBy("day").parquet(path)
    many = len(spark.read.parquet(path).inputFiles())
    assert sinks.compact_days(spark, path, small_files=4, days_at_once=1) == [date(2026, 4, 1), date(2026, 4, 2)]
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) < many and stored.count() == 402 and stored.select("day", "id").distinct().count() == 402
    assert sinks.compact_days(spark, path, small_files=4) == []


def test_an_interrupted_reset_is_finished_by_the_next_start(spark, monkeypatch):
    root = scratch_path(spark, "reset")
    progress, out = f"{root}/progress", f"{root}/out"
    numbers(spark, 3).write.parquet(f"{root}/in")

    def drain():
        stream = spark.readStream.schema("k long, v long").parquet(f"{root}/in")
        run.start(stream, sinks.parquet_batch_sink(out), progress, run.StreamSettings(output_mode="append")).awaitTermination()

    drain()
    # the driver is lost after the output went and before the progress did
    removed = []

    def remove(session, path, really=files.remove):
        if removed:
            raise ConnectionError("driver lost")
        removed.append(path)
        really(session, path)

    with monkeypatch.context() as broken:
        broken.setattr(run.files, "remove", remove)
        with pytest.raises(ConnectionError):
            run.reset(spark, progress, out)
    assert not files.exists(spark, out) and files.exists(spark, progress)
    drain()
    assert spark.read.parquet(out).count() == 3 and not run.finish_reset(spark, progress)
    run.reset(spark, progress, out)
    assert not files.exists(spark, out) and not files.exists(spark, progress)


def test_the_ledger_keeps_the_last_batch_only(spark):
    ledger = sinks.Ledger(spark, scratch_path(spark, "ledger"))
    took = []
    fan = sinks.fan_out({"one": lambda b, i: took.append(("one", i)), "two": lambda b, i: took.append(("two", i))}, ledger)
    frame = spark.range(1)
    for batch in (0, 1, 1, 2):
        fan(frame, batch)
    assert took == [("one", 0), ("two", 0), ("one", 1), ("two", 1), ("one", 2), ("two", 2)]
    assert files.names(spark, ledger.path) == ["2"]


def test_claims_are_taken_once(spark):
    path = f"{scratch_path(spark, 'claim')}/x"
    assert files.claim(spark, path, "ä") and not files.claim(spark, path, "b") and files.read(spark, path) == "ä"
    assert json.dumps(files.names(spark, path + "/none")) == "[]"
