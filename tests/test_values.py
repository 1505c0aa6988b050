"""Parsing, clamping and flags on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart import config
from hazemart.functions import coerce, derive
from hazemart.operators.cleaning import CONTEXT_COLUMNS, READING_COLUMNS, CleaningAudit, clean_context, clean_readings, cleaning_audit

RAW = "site_id string, time string, " + ", ".join(f"{c} string" for c in config.READING_LIMITS)


def reading(site="3837.0", time="2026-04-01 05:00:00", **values):
    return tuple([site, time] + [values.get(c) for c in config.READING_LIMITS])


@pytest.fixture(scope="module")
def clean(spark):
    def run(*raw):
        return {
            (r.site_id, r.timestamp): r for r in clean_readings(spark.createDataFrame(list(raw), RAW)).collect()
        }

    return run


def test_decimal_comma_and_key_text(clean):
    (row,) = clean(reading(aqi="12,5")).values()
    assert row.aqi == 12.5 and row.site_id == 3837 and row.hour == 5 and row.month == 4
    assert row.date == dt.date(2026, 4, 1)


def test_bad_number_keeps_row_and_bad_key_or_time_drops_it(clean):
    kept = clean(reading(aqi="n/a"), reading(time="yesterday"), reading(site="x"), reading(site=None), reading(time=None))
    assert len(kept) == 1
    assert next(iter(kept.values())).aqi is None


@pytest.mark.parametrize("text, expected", [("0", 0.0), ("1000", 1000.0), ("1000.1", None), ("-1", None), ("NaN", None), ("Infinity", None)])
def test_limits_are_inclusive(clean, text, expected):
    (row,) = clean(reading(aqi=text)).values()
    assert row.aqi == expected
    assert row.has_missing_pollution_value is True


@pytest.mark.parametrize(
    "values, peak",
    [({"aqi": "100"}, False), ({"aqi": "100.1"}, True), ({"pm25": "35"}, False), ({"pm25": "35.1"}, True),
     ({"pm10": "150.5"}, True), ({}, False), ({"pm25": "NaN"}, False)],
)
def test_peak_ignores_unknown_values(clean, values, peak):
    (row,) = clean(reading(**values)).values()
    assert row.is_pollution_peak is peak


def test_duplicates_have_a_declared_survivor(spark):
    raw = spark.createDataFrame([reading(aqi="20"), reading(aqi="10"), reading(aqi="30")], RAW)
    for parts in (1, 3, 7):
        assert [r.aqi for r in clean_readings(raw.repartition(parts)).collect()] == [10.0]
    assert clean_readings(raw).columns == list(READING_COLUMNS)


def test_cleaning_twice_changes_nothing(spark, rows):
    once = clean_readings(spark.createDataFrame([reading(aqi="20"), reading(aqi="2000", pm25="1")], RAW))
    again = clean_readings(
        once.select(F.col("site_id").cast("string").alias("site_id"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("time"),
                    *[F.col(c).cast("string").alias(c) for c in config.READING_LIMITS])
    )
    assert rows(once) == rows(again)


def test_context_buckets(spark):
    names = ["time", *config.CONTEXT_SOURCE.values()]
    speeds = [None, "1.99", "2", "4.99", "5"]
    data = [
        tuple(f"2026-04-01T{i:02d}:00" if c == "time" else speed if c == "wind_speed_10m" else "0,5" if c == "precipitation" else None for c in names)
        for i, speed in enumerate(speeds)
    ]
    found = clean_context(spark.createDataFrame(data, ", ".join(f"{c} string" for c in names)))
    assert found.columns == list(CONTEXT_COLUMNS)
    ordered = found.orderBy("timestamp").collect()
    assert [r.wind_speed_group for r in ordered] == ["unknown", "calm", "moderate", "moderate", "strong"]
    assert all(r.has_precipitation for r in ordered)


def test_boolean_variants(spark):
    df = spark.createDataFrame([("TRUE",), ("no",), (None,)], "t string")
    mart = [r[0] for r in df.select(coerce.boolean(F.col("t"))).collect()]
    serving = [r[0] for r in df.select(coerce.boolean(F.col("t"), unknown=False)).collect()]
    assert mart == [True, False, None]
    assert serving == [True, False, False]


def test_any_of_three_time_formats(spark):
    texts = ["2026-04-01 05:06:07", "2026-04-01T05:06", " 2026-4-1 ", "01.04.2026", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(coerce.timestamp_any(F.col("t"))).collect()] == [
        dt.datetime(2026, 4, 1, 5, 6, 7), dt.datetime(2026, 4, 1, 5, 6), dt.datetime(2026, 4, 1), None, None,
    ]


def test_schema_coercion_never_fails(spark):
    schema = T.StructType([
        T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.TimestampType()),
        T.StructField("d", T.DateType()), T.StructField("e", T.BooleanType()), T.StructField("f", T.StringType()),
    ])
    df = spark.createDataFrame(
        [("1.0", "2,5", "2026-04-01 01:00:00", "2026-04-01", "maybe", "x"), ("99999999999", "?", "?", "?", None, None)],
        "f0 string, b string, c string, d string, e string, f string",
    ).withColumnRenamed("f0", "a")
    first, second = coerce.coerce_to(df, schema, unknown_bool=False).collect()
    assert tuple(first) == (1, None, dt.datetime(2026, 4, 1, 1), dt.date(2026, 4, 1), False, "x")
    assert tuple(second) == (None, None, None, None, False, None)


def test_severity_and_fill(spark):
    df = spark.createDataFrame([(None, None), (1, 0), (1, 3)], "p int, l int").withColumns(derive.fill({"p": 0, "l": 0}))
    assert [r[0] for r in df.select(derive.severity(F.col("p"), F.col("l"))).collect()] == [0, 1, 4]


def test_audit_and_observation(spark):
    rows = [reading(), reading(), reading(time="?"), reading(site="x", time="?")]
    raw = spark.createDataFrame(rows, RAW)
    wanted = {"raw_rows": 4, "bad_key_rows": 1, "bad_time_rows": 1, "cleaned_rows": 1, "removed_rows": 3, "duplicate_rows": 1}
    assert cleaning_audit(raw, clean_readings(raw)).first().asDict() == wanted
    # an observation makes its session unfit for Spark ML's summaries, so it gets one of its own
    own, audit = spark.newSession().createDataFrame(rows, RAW), CleaningAudit()
    cleaned = audit.clean(own)
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    cleaned.write.format("noop").mode("overwrite").save()
    # the counts came with the write, nothing is run for them
    spark.sparkContext.setJobGroup("counts", "counts")
    assert audit.counts() == wanted
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("counts")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
