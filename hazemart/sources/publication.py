"""A set of tables that is replaced as a whole.

Every publication writes all its tables into a version folder of its own and reads them back: schemas must be
those of the plans, and every row must hold what the caller declares of its table. Only then one small file is created, and with it the version is the current one; up to
that moment readers and catalog views see the version before. A publication that fails, whether in a task, in the
examination or by the loss of the driver, leaves the set as it was and at most a folder without that file.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.sources import files

COMPLETE, CLAIMED = "_COMPLETE", "_CLAIMED"


class InvalidSet(RuntimeError):
    """What was written is not what was to be written."""


def _plain(schema: T.StructType) -> T.StructType:
    """The schema as files keep it: every field may be null."""
    def loose(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, loose(f.dataType)) for f in kind])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(loose(kind.elementType))
        return T.MapType(loose(kind.keyType), loose(kind.valueType)) if isinstance(kind, T.MapType) else kind

    return loose(schema)


def _folder(location: str, version: int) -> str:
    return f"{location}/version={version:08d}"


def _versions(spark: SparkSession, location: str) -> list[int]:
    return [int(n.removeprefix("version=")) for n in files.names(spark, location) if n.startswith("version=")]


def current_version(spark: SparkSession, location: str) -> int | None:
    """The newest version whose publication was finished."""
    done = [v for v in _versions(spark, location) if files.exists(spark, f"{_folder(location, v)}/{COMPLETE}")]
    return max(done, default=None)


def _next_version(spark: SparkSession, location: str) -> int:
    version = max(_versions(spark, location), default=0) + 1
    while not files.claim(spark, f"{_folder(location, version)}/{CLAIMED}"):
        version += 1
    return version


class Draft:
    """A version that is being written; nothing of it is seen before :meth:`finish`."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")
        self.version = _next_version(spark, self.location)
        self.folder = _folder(self.location, self.version)
        self.tables: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame, must: Column | None = None) -> DataFrame:
        """Writes one table by its executors, examines what is stored and returns it; ``must`` is to hold of every row."""
        df.write.mode("error").parquet(f"{self.folder}/{name}")
        stored = self.spark.read.parquet(f"{self.folder}/{name}")
        if [(f.name, f.dataType) for f in _plain(stored.schema)] != [(f.name, f.dataType) for f in _plain(df.schema)]:
            raise InvalidSet(f"{name}: {stored.schema.simpleString()} was stored for {df.schema.simpleString()}")
        broken = F.count_if(~F.coalesce(must, F.lit(False))) if must is not None else F.lit(0).cast("long")
        rows, bad = stored.agg(F.count(F.lit(1)), broken).first()
        if bad:
            raise InvalidSet(f"{name}: {bad} of {rows} rows are not as declared")
        self.tables[name] = {"rows": rows, "schema": df.schema.jsonValue()}
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def finish(self) -> int:
        """Makes this version the current one, in one step."""
        newest = current_version(self.spark, self.location)
        if newest is not None and newest > self.version:
            raise InvalidSet(f"version {newest} was published while version {self.version} was written")
        if not files.claim(self.spark, f"{self.folder}/{COMPLETE}", json.dumps(self.tables)):
            raise InvalidSet(f"version {self.version} is finished already")
        return self.version

    def drop(self) -> None:
        files.remove(self.spark, self.folder)


def publish_set(
    spark: SparkSession, location: str, tables: dict[str, DataFrame],
    derived: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None, must: dict[str, Column] | None = None,
) -> int:
    """Replaces the set below ``location`` by ``tables`` and what ``derived`` makes of the stored ones; the new version.

    ``must`` declares by table name what holds of every row. Whatever fails, the version before stays the current one and the unfinished folder is removed.
    """
    draft, must = Draft(spark, location), must or {}
    try:
        stored = {name: draft.write(name, df, must.get(name)) for name, df in tables.items()}
        for name, df in (derived(stored) if derived else {}).items():
            draft.write(name, df, must.get(name))
        return draft.finish()
    except BaseException:
        draft.drop()
        raise


def current_set(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """All tables of the current version, each with its declared schema; none before the first publication."""
    version = current_version(spark, location)
    if version is None:
        return {}
    folder = _folder(location.rstrip("/"), version)
    known = json.loads(files.read(spark, f"{folder}/{COMPLETE}"))
    return {name: spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(f"{folder}/{name}") for name, t in known.items()}


def point_views(spark: SparkSession, location: str, texts: dict[str, str] | None = None) -> None:
    """Catalog views over the current version: one for each of its tables, and those of ``texts``.

    A text names the tables of the set in braces; each view reads one version throughout. To be repeated after an
    interruption, it depends on the current version alone. A catalog table that stands where a view is to be is dropped, its files stay.
    """
    version = current_version(spark, location)
    folder = _folder(location.rstrip("/"), version)
    relations = {name: f"parquet.`{folder}/{name}`" for name in json.loads(files.read(spark, f"{folder}/{COMPLETE}"))}
    bodies = {name: f"SELECT * FROM {relation}" for name, relation in relations.items()}
    bodies |= {name: text.format(**relations) for name, text in (texts or {}).items()}
    for name, body in bodies.items():
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY"):
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")


def prune(spark: SparkSession, location: str, keep: int = 2) -> list[int]:
    """Removes finished versions beyond the newest ``keep`` (the current one stays) and unfinished ones below the current; what was removed."""
    current = current_version(spark, location)
    if current is None:
        return []
    done = [v for v in _versions(spark, location) if files.exists(spark, f"{_folder(location, v)}/{COMPLETE}")]
    kept = set(sorted(done)[-max(keep, 1):])
    gone = [v for v in _versions(spark, location) if v < current and v not in kept]
    for version in gone:
        files.remove(spark, _folder(location, version))
    return gone
