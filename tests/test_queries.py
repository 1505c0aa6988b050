"""Every registered query against its SQL, on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from hazemart.bindings import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
ROWS_ONLY = {"ml_tfidf", "ml_regress", "ml_classify", "ml_kmeans"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        return None if math.isnan(value) else float(value)
    if hasattr(value, "isoformat"):
        return str(pd.Timestamp(value))
    return value.item() if hasattr(value, "item") else value


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(shaped, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    found = canonical(result.columns, [tuple(r) for r in result.collect()])
    answer = duck.execute(ORACLES[name])
    expected = canonical([d[0] for d in answer.description], answer.fetchall())
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
