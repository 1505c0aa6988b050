"""Order statistics against brute force, with one group holding a third of the rows or more."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hazemart.operators import anomaly, compare, integers, quality
from hazemart.operators.ordered import competition_ranks, exact_quantiles, previous_value, running_before

DRAW = random.Random(5)
# key 0 is hot, key None exists, values repeat, one value makes up a third of the hot key
DATA = [(0, 7.0 if DRAW.random() < 0.33 else round(DRAW.gauss(0, 50), 2)) for _ in range(3000)]
DATA += [(DRAW.randint(1, 20), DRAW.choice([1.0, 2.0, 3.5, None])) for _ in range(1500)]
DATA += [(None, float(i)) for i in range(11)] + [(99, 4.25)] + [(98, None)]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(DATA, "k int, v double").repartition(7)


def groups():
    out = {}
    for k, v in DATA:
        out.setdefault(k, [])
        if v is not None:
            out[k].append(v)
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("slices", [2, 3, 16, 1000, 4096])
def test_quantiles_are_exact(data, slices):
    wanted = {"a": 0.25, "b": 0.5, "c": 0.9}
    found = {r.k: (r.a, r.b, r.c) for r in exact_quantiles(data, ["k"], "v", wanted, slices).collect()}
    expected = groups()
    assert set(found) == set(expected)
    for k, values in expected.items():
        assert found[k] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.9])), abs=1e-9), k


def test_quantile_of_the_whole_table(data):
    (row,) = exact_quantiles(data, [], "v", {"m": 0.5}).collect()
    assert row.m == pytest.approx(np.quantile([v for _, v in DATA if v is not None], 0.5))


@pytest.mark.parametrize("slices", [2, 60, 1024])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sum(data, keys, slices):
    counts = data.where("v IS NOT NULL").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    if not keys:
        counts = counts.groupBy("v").agg(F.sum("n").alias("n"))
    found = running_before(counts, keys, "v", "n", "below", slices=slices).collect()
    for r in found:
        pool = groups()[r.k] if keys else [v for _, v in DATA if v is not None]
        assert (r.below or 0) == sum(1 for v in pool if v < r.v)
    assert len(found) == counts.count()


def test_ranks_with_ties_and_nulls(spark):
    scores = [5.0, 7.0, 7.0, None, 1.0, 7.0, 5.0]
    df = spark.createDataFrame(list(enumerate(scores)), "i int, s double")
    found = [r.place for r in competition_ranks(df, {"place": "s"}).orderBy("i").collect()]
    assert found == [4, 1, 1, 7, 6, 1, 4]


def test_previous_value_equals_lag(spark):
    start = dt.datetime(2026, 1, 1)
    data = []
    for i in range(2000):
        key = 0 if i % 3 == 0 else None if i % 50 == 0 else DRAW.randint(1, 5)
        # gaps of many days for some keys, equal times told apart by the number
        data.append((key, start + dt.timedelta(hours=DRAW.randint(0, 24 * (60 if key == 5 else 10))), i, DRAW.choice([None, 1.0, 2.0, 3.0])))
    df = spark.createDataFrame(data, "k int, t timestamp, i int, v double").repartition(5)
    found = {r.i: r.p for r in previous_value(df, ["k"], ["t", "i"], "v", F.date_trunc("DAY", "t"), "p").collect()}
    lagged = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "i")))
    assert found == {r.i: r.p for r in lagged.collect()}
    minutes = anomaly.jumps(df, ["k"], "t", "v", 1.5, ["i"], piece_unit="MINUTE")
    assert found == {r.i: r.previous_value for r in minutes.collect()}


def test_outliers_and_deviation_keep_every_row(data):
    flagged = anomaly.iqr_outliers(data, ["k"], "v")
    assert flagged.count() == len(DATA)
    q1, q3 = np.quantile(groups()[0], [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    expected = sum(1 for v in groups()[0] if v < low or v > high)
    assert flagged.where("k = 0 AND is_outlier").count() == expected
    assert flagged.where("v IS NULL AND is_outlier").count() == 0
    assert anomaly.median_deviation(data, ["k"], "v").where("k = 99").first().deviation == 0.0
    sketched = anomaly.iqr_outliers(data, ["k"], "v", accuracy=10000)
    assert abs(sketched.where("k = 0 AND is_outlier").count() - expected) <= 5


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_edges_are_found_once(data, keys):
    """Both branches of a plan read the edges from files, so neither holds the sketch."""
    plan = exact_quantiles(data, keys, "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan
    assert "edges-" in plan


def test_gaps_of_null_sites_and_stray_times(spark):
    t = dt.datetime(2026, 1, 1)
    far = dt.datetime(2026, 1, 1) + dt.timedelta(days=400)
    data = [(1, t), (None, t), (None, t + dt.timedelta(hours=1)), (1, far)]
    found = quality.hourly_gaps(spark.createDataFrame(data, "site_id int, timestamp timestamp")).collect()
    hours = 400 * 24 + 1
    assert sum(r.site_id == 1 for r in found) == hours - 2
    assert sum(r.site_id is None for r in found) == hours - 2


def test_a_stray_hour_costs_one_interval(spark):
    t = dt.datetime(2026, 1, 1)
    data = [(s, t + dt.timedelta(hours=h)) for s in range(4) for h in (0, 1, 2)] + [(0, dt.datetime(2926, 1, 1))]
    found = quality.gap_intervals(spark.createDataFrame(data, "site_id int, timestamp timestamp")).collect()
    hours = int((dt.datetime(2926, 1, 1) - t).total_seconds()) // 3600
    assert sorted((r.site_id, r.hours) for r in found) == [(0, hours - 3), (1, hours - 2), (2, hours - 2), (3, hours - 2)]


def test_gaps(spark):
    t = dt.datetime(2026, 1, 1)
    data = [(1, t), (1, t + dt.timedelta(hours=3, minutes=20)), (2, t + dt.timedelta(hours=1)), (2, t + dt.timedelta(hours=1, minutes=1)), (3, None)]
    found = quality.hourly_gaps(spark.createDataFrame(data, "site_id int, timestamp timestamp"))
    assert sorted((r.site_id, r.hour_start.hour) for r in found.collect()) == [(1, 1), (1, 2), (2, 0), (2, 2), (2, 3)]


def test_integer_jobs(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big,), (big,), (3,), (None,), (-5,)], "value long")
    assert integers.largest(df).first()[0] == big
    assert integers.mean(df).first()[0] == pytest.approx((2 * big - 2) / 4)
    assert sorted(r[0] for r in integers.distinct(df).collect()) == [-5, 3, big]
    assert integers.distinct_count(df).first()[0] == 3
    assert integers.distinct_count(df, relative_error=0.05).first()[0] == 3


def test_season_and_weekend_labels(spark):
    days = [dt.datetime(2026, m, 1) for m in range(1, 13)]
    df = spark.createDataFrame([(d, 1.0) for d in days], "t timestamp, v double")
    assert {r.season: r.row_count for r in compare.by_season(df, "t", "v").collect()} == dict.fromkeys(["winter", "spring", "summer", "autumn"], 3)
    weekend = sum(1 for d in days if d.weekday() >= 5)
    assert {r.day_kind: r.row_count for r in compare.by_weekend(df, "t", "v").collect()}["weekend"] == weekend
