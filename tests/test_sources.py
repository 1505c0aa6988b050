"""Payloads, chunks, provenance, text tables and sinks."""

import datetime as dt
import json

import pytest

from hazemart.operators.dedup import last_per_key
from hazemart.session import scratch_path, shared_folder
from hazemart.sources import ingest, payload, sinks, streams, tabular


@pytest.mark.parametrize(
    "body, count",
    [
        ({"data": [{"site": 1}, {"site": 2}]}, 2), ({"data": {"items": [{"site": 1}]}}, 1), ({"data": {"rows": [{}]}}, 1),
        ({"data": {"measurements": [{}, {}, {}]}}, 3), ({"data": {"values": [{}]}}, 1), ({"data": {"items": 5, "values": [{}]}}, 1),
        ({"data": {"items": {}}}, 0), ({"data": {}}, 0), ({"data": None}, 0), ({}, 0), ({"data": []}, 0), ({"data": "x"}, 0), ([1], 0),
    ],
)
def test_record_places(spark, body, count):
    df = spark.createDataFrame([(json.dumps(body),)], "p string")
    assert payload.records(df, "p").count() == count


def test_malformed_payload_has_no_rows(spark):
    assert payload.records(spark.createDataFrame([("{oops",), (None,), ("",)], "p string"), "p").count() == 0


def test_aliases_keep_zero_and_raw_text(spark):
    record = '{"site_id": 7, "datetime": "2026-01-01", "t": 0, "temperature": 5, "p": null, "pressure": "700"}'
    df = spark.createDataFrame([('{"data": [' + record + "]}",)], "p string")
    found = payload.records(df, "p")
    row = payload.resolve_aliases(found, "_raw", payload.READING_ALIASES, keep=["_raw"]).first()
    assert (row.site_id, row.time, row.temperature, row.pressure, row.aqi) == ("7", "2026-01-01", "0", "700", None)
    assert json.loads(row._raw) == json.loads(record)


def test_parallel_arrays(spark):
    bodies = [
        {"hourly": {"time": ["a", "b"], "rain": [1], "snowfall": [3, 4, 5]}}, {"hourly": {"rain": [1]}}, {"hourly": [1]}, {},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "p string")
    found = payload.parallel_arrays(df, "p", ["rain", "snowfall", "missing"]).orderBy("row_no").collect()
    assert [(r.time, r.rain, r.snowfall, r.missing) for r in found] == [("a", "1", "3", None), ("b", None, "4", None)]


def test_site_dimension(spark):
    projects = spark.createDataFrame(
        [(json.dumps({"data": [{"id": 1, "name": "P", "short_name": "p"}, {"name": "no id"}, {"id": 2, "name": "Q"}]}),)], "payload string"
    )
    bodies = [
        (1, {"data": {"sites": [{"id": 11, "title": "t", "lat": 1.5, "lon": 2}, {"id": None}, {"id": 10, "name": "n", "title": "x", "geom_y": 0, "lat": 9}]}}),
        (2, {"data": {"sites": [{"id": 12}]}}), (2, {"data": []}), (3, {"data": {"sites": [{"id": 13}]}}),
    ]
    site_payloads = spark.createDataFrame([(i, json.dumps(b)) for i, b in bodies], "project_id int, payload string")
    found = payload.site_dimension(projects, site_payloads).orderBy("site_id").collect()
    assert [(r.site_id, r.site_name, r.project_name, r.latitude, r.longitude) for r in found] == [
        (10, "n", "P", 0.0, None), (11, "t", "P", 1.5, 2.0), (12, None, "Q", None, None),
    ]
    ids = spark.createDataFrame([(11,), (11,), (77,)], "site_id int")
    assert [r.site_id for r in payload.site_dimension(projects, site_payloads, ids).collect()] == [11]


def test_raw_row_keeps_nulls(spark):
    row = payload.keep_raw(spark.createDataFrame([(1, None)], "a int, b string")).first()
    assert json.loads(row._raw) == {"a": 1, "b": None}


def ranges(spark, start, end):
    return spark.createDataFrame([(start, end)], "s timestamp, e timestamp")


def test_time_chunks(spark):
    df = ranges(spark, dt.datetime(2026, 1, 1, 6), dt.datetime(2026, 2, 5))
    found = ingest.time_chunks(df, "s", "e", 15).orderBy("chunk_start").collect()
    assert [(r.chunk_start, r.chunk_end) for r in found] == [
        (dt.datetime(2026, 1, 1, 6), dt.datetime(2026, 1, 16, 6)), (dt.datetime(2026, 1, 16, 6), dt.datetime(2026, 1, 31, 6)),
        (dt.datetime(2026, 1, 31, 6), dt.datetime(2026, 2, 5)),
    ]


def test_date_chunks_end_the_second_before(spark):
    df = ranges(spark, dt.datetime(2026, 1, 1, 6), dt.datetime(2026, 1, 31))
    found = ingest.date_chunks(df, "s", "e", 15).orderBy("chunk_start").collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in found] == [(1, 15), (16, 30)]


def test_bad_ranges_fail(spark):
    with pytest.raises(ValueError):
        ingest.time_chunks(ranges(spark, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)), "s", "e", 0)
    with pytest.raises(Exception, match="after its start"):
        ingest.time_chunks(ranges(spark, dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2)), "s", "e", 1).collect()


def test_first_arrival_and_audit(spark):
    data = [("a", 0, 0), ("b", 0, 1), ("a", 1, 2), ("a", 1, 3), ("c", 1, 4), ("a", 2, 5)]
    df = spark.createDataFrame(data, "key string, chunk int, seq int")
    kept = ingest.keep_first(df, ["key"], ["chunk", "seq"])
    assert sorted((r.key, r.seq) for r in kept.collect()) == [("a", 0), ("b", 1), ("c", 4)]
    audit = {r.chunk: (r.rows_count, r.added_rows_count) for r in ingest.ingest_audit(df, ["key"], "chunk").collect()}
    assert audit == {0: (2, 2), 1: (3, 1), 2: (1, 0)}
    assert sorted(r.seq for r in last_per_key(df, ["key"], "seq").collect()) == [1, 4, 5]


def test_union_pages_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(tuple(r) for r in ingest.union_pages([a, b, b]).collect()) == [(1, "x"), (2, "y"), (2, "y")]


def test_fallback(spark):
    df = spark.createDataFrame([(1,), (2,)], "i int")
    assert {r.source for r in ingest.with_fallback(df.where("i > 1"), df).collect()} == {"parsed"}
    assert [(r.i, r.source) for r in ingest.with_fallback(df.where("i > 9"), df).orderBy("i").collect()] == [(1, "fallback"), (2, "fallback")]


def test_text_table_round_trip(spark, rows):
    data = [("1", 'say "hi", twice'), ("2", " padded "), ("3", "строка\nвторая\n\n"), ("4", None), ("5", "a\\b\"")]
    df = spark.createDataFrame(data, "id string, note string")
    path = scratch_path(spark, "csv")
    sinks.export_csv(df, path)
    assert rows(tabular.read_text_table(spark, path, ["id", "note"], multi_line=True)) == rows(df)


def test_integers(spark):
    path = scratch_path(spark, "ints")
    spark.createDataFrame([(" 5 ",), ("x",), ("-9000000000",)], "value string").write.text(path)
    assert sorted(r.value or 0 for r in tabular.read_integers(spark, path).collect()) == [-9000000000, 0, 5]


def test_staging_replaces_only_the_days_it_brings(spark):
    path = scratch_path(spark, "staging")
    sinks.write_staging(spark.sql("SELECT DATE'2026-01-01' AS date, 1 AS v UNION ALL SELECT DATE'2026-01-02', 2"), path)
    sinks.write_staging(spark.sql("SELECT DATE'2026-01-02' AS date, 3 AS v"), path)
    assert sorted((r.date.day, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 3)]


def test_json_snapshot(spark):
    path = scratch_path(spark, "json")
    sinks.write_json_snapshot(spark.createDataFrame([(1, None)], "a int, b string"), spark.createDataFrame([(1,)], "n int"), path)
    assert [json.loads(r.value) for r in spark.read.text(f"{path}/rows").collect()] == [{"a": 1, "b": None}]


def test_message_frame(spark):
    df = spark.createDataFrame([(7, None)], "site_id int, v double")
    plain, full = sinks.key_value(df, "site_id").first(), sinks.key_value(df, "site_id", ignore_nulls=False).first()
    assert (plain.key, plain.value, full.value) == ("7", '{"site_id":7}', '{"site_id":7,"v":null}')


class Recorder:
    """Stands in for a frame and its writer and notes what it is told."""

    def __init__(self, log):
        self.log = log

    @property
    def write(self):
        return self

    def format(self, name):
        self.log.append(("format", name))
        return self

    def options(self, **options):
        self.log.append(("options", options))
        return self

    def mode(self, mode):
        self.log.append(("mode", mode))
        return self

    def save(self):
        self.log.append(("save",))

    def persist(self):
        self.log.append(("persist",))

    def unpersist(self):
        self.log.append(("unpersist",))


def test_jdbc_sink_overwrites_and_truncates():
    log = []
    sinks.jdbc_snapshot_sink("jdbc:x", "t", user="u")(Recorder(log), 0)
    assert log == [("format", "jdbc"), ("options", {"url": "jdbc:x", "dbtable": "t", "truncate": "true", "user": "u"}), ("mode", "overwrite"), ("save",)]


def test_fan_out_computes_once_and_releases_on_failure():
    log = []

    def broken(batch, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        sinks.fan_out([lambda b, i: log.append(("first", i)), broken])(Recorder(log), 4)
    assert log == [("persist",), ("first", 4), ("unpersist",)]


def test_kafka_source_checks_its_offsets(spark):
    with pytest.raises(ValueError):
        streams.kafka_events(spark, "h:1", "t", "middle")


def test_scratch_lies_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark) + "/")
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == shared_folder(spark)
