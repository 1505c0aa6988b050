"""The submitted jobs from raw files to published views."""

import pytest
from pyspark.sql import functions as F

from hazemart import config, jobs, session
from hazemart.session import scratch_path
from hazemart.sources import sinks


@pytest.fixture(scope="module")
def root(spark):
    return scratch_path(spark, "jobs")


def submit(spark, *argv):
    args = jobs.arguments().parse_args(list(argv))
    args.run(spark, args)


def test_raw_files_to_views(spark, root):
    grid = spark.range(3).select(F.col("id").alias("s"), F.explode(F.expr(
        "sequence(timestamp'2026-04-01', timestamp'2026-04-10 23:00:00', interval 1 hour)")).alias("t"))
    noise = F.pmod(F.xxhash64("s", "t"), F.lit(100))
    readings = grid.select(
        F.col("s").cast("string").alias("site_id"), F.date_format("t", config.READING_TIME_FORMAT).alias("time"),
        *[F.concat((noise + 10).cast("string"), F.lit(",5")).alias(c) for c in config.READING_LIMITS], F.lit('{"a": "b"}').alias("_raw"),
    )
    context = grid.where("s = 0").select(
        F.date_format("t", config.CONTEXT_TIME_FORMAT).alias("time"),
        *[
            (F.pmod(F.xxhash64("t", F.lit(c)), F.lit(8)) + (700 if c == "surface_pressure" else 0)).cast("string").alias(c)
            for c in config.CONTEXT_SOURCE.values()
        ],
    )
    pages = spark.createDataFrame(
        [("u", "<p>06.04.2026 Первый режим НМУ с 5 часов 6 апреля 2026 до 9 часов 6 апреля 2026</p>")], "url string, html string"
    )
    sites = spark.createDataFrame([("0", "zero")], "site_id string, site_name string").withColumns(
        {c: F.lit(None).cast("string") for c in jobs.SITE_SOURCE[2:]}
    )
    sinks.export_csv(readings, f"{root}/in/readings")
    sinks.export_csv(context, f"{root}/in/context")
    sinks.export_csv(sites, f"{root}/in/sites")
    pages.write.parquet(f"{root}/in/pages")

    submit(spark, "notices", "--pages", f"{root}/in/pages", "--output", f"{root}/in/notices")
    submit(spark, "layers", "--readings", f"{root}/in/readings", "--context", f"{root}/in/context", "--notices", f"{root}/in/notices", "--root", root)
    submit(spark, "train", "--root", root, "--clusters", "2")
    submit(spark, "publish", "--root", root, "--sites", f"{root}/in/sites", "--location", f"{root}/serving")

    assert spark.table("v_air_daily_by_site").count() == 30
    assert {r.nmu_status: r.rows_count for r in spark.table("v_pollution_by_nmu").collect()} == {"НМУ": 12, "Обычные часы": 708}
    assert spark.table("v_ml_metrics").count() == 14
    assert spark.table("v_ml_cluster_profile").count() == 2
    assert spark.table("v_ml_classification").columns[-1] == "is_correct"
    assert spark.table("v_ml_regression").where("site_name = 'zero'").count() == 240


def test_saved_payloads_become_raw_tables(spark, root):
    body = '{"data": {"items": [{"site": 5, "date": "2026-04-01 00:00:00", "aqi": "1,5", "t": 3}, {"site_id": 6, "time": "x", "h": null}]}}'
    weather = '{"hourly": {"time": ["2026-04-01T00:00"], "temperature_2m": [1.5], "rain": []}}'
    for name, text in (("p", body), ("w", weather)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/in/{name}")
    submit(spark, "payloads", "--kind", "readings", "--files", f"{root}/in/p", "--output", f"{root}/in/p-rows")
    submit(spark, "payloads", "--kind", "context", "--files", f"{root}/in/w", "--output", f"{root}/in/w-rows")
    rows = jobs.tabular.read_text_table(spark, f"{root}/in/p-rows", jobs.READING_SOURCE).orderBy("site_id").collect()
    assert [(r.site_id, r.time, r.aqi, r.temperature, r.humidity) for r in rows] == [("5", "2026-04-01 00:00:00", "1,5", "3", None), ("6", "x", None, None, None)]
    (context,) = jobs.tabular.read_text_table(spark, f"{root}/in/w-rows", jobs.CONTEXT_SOURCE).collect()
    assert (context.time, context.temperature_2m, context.rain) == ("2026-04-01T00:00", "1.5", None)


def test_site_payloads_become_the_site_table(spark, root):
    projects = '{"data": [{"id": 3, "name": "City", "short_name": "C"}, {"id": 4, "name": "Town", "short_name": "T"}]}'
    spark.createDataFrame([(projects,)], "value string").coalesce(1).write.text(f"{root}/in/projects")
    for project, sites in (("3", '[{"id": 7, "name": "seven", "lat": "43.2"}, {"id": "x"}]'), ("4", '[{"id": 8, "name": "eight"}]')):
        place, body = f"{root}/in/site-payloads/{project}.json", '{"data": {"sites": %s}}' % sites
        assert jobs.sinks.files.claim(spark, place, body)
    with pytest.raises(ValueError, match="projects"):
        submit(spark, "payloads", "--kind", "sites", "--files", f"{root}/in/site-payloads", "--output", f"{root}/in/site-rows")
    submit(spark, "payloads", "--kind", "sites", "--projects", f"{root}/in/projects", "--files", f"{root}/in/site-payloads", "--output", f"{root}/in/site-rows")
    rows = jobs.tabular.read_text_table(spark, f"{root}/in/site-rows", jobs.SITE_SOURCE).orderBy("site_id").collect()
    assert [(r.site_id, r.site_name, r.project_id, r.project_short_name) for r in rows] == [("7", "seven", "3", "C"), ("8", "eight", "4", "T")]


def test_views_outlive_the_session(spark, root):
    """A new session on the same catalog reads every view that the publish job left."""
    fresh = spark.newSession()
    names = {t.name for t in fresh.catalog.listTables() if t.name.startswith("v_")}
    assert len(names) == 13 and not any(t.isTemporary for t in fresh.catalog.listTables() if t.name in names)
    for name in names:
        assert fresh.table(name).count() > 0 or name == "v_ml_feature_importance"


def test_stream_views_are_published(spark, root):
    windows = spark.createDataFrame(
        [("2026-04-01 00:00:00", "2026-04-01 01:00:00", 0, "zero", 1.0, 2.0, 3.0, 1, 4)], list(jobs.ev.WINDOW_COLUMNS)
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    sinks.lake_window_sink(f"{root}/lake")(windows, 0)
    sinks.lake_window_sink(f"{root}/lake")(windows.withColumn("sample_count", F.lit(9).cast("long")), 1)
    sinks.lake_window_sink(f"{root}/lake")(windows.withColumn("sample_count", F.lit(9).cast("long")), 1)
    submit(spark, "publish", "--root", root, "--sites", f"{root}/in/sites", "--location", f"{root}/serving", "--windows", f"{root}/lake")
    fresh = spark.newSession()
    assert [r.sample_count for r in fresh.table("v_stream_aggregates").collect()] == [9]
    assert fresh.table("v_stream_site_summary").first().total_samples == 9


def test_scratch_space_removes_what_was_settled(spark):
    with session.scratch_space(spark):
        path = session.settled(spark.range(3).toDF("x"), "gone").inputFiles()[0].rpartition("/")[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_pages_without_notices_fall_back(spark, root):
    spark.createDataFrame([("u", "<p>nothing</p>")], "url string, html string").write.parquet(f"{root}/in/empty")
    submit(spark, "notices", "--pages", f"{root}/in/empty", "--output", f"{root}/in/seeds")
    found = jobs.read_notices(spark, f"{root}/in/seeds")
    assert found.count() == 6
    assert {r.source for r in found.collect()} == {"fallback"}


def test_snapshot_table_needs_complete_mode(spark):
    args = jobs.arguments().parse_args(
        ["stream", "--servers", "h:1", "--topic", "a", "--out-topic", "b", "--checkpoint", "c", "--output-mode", "update", "--jdbc-url", "jdbc:x"]
    )
    with pytest.raises(ValueError, match="complete"):
        args.run(spark, args)
