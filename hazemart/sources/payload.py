"""Nested JSON payloads to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.operators.joins import keep_ids

# fixed values: names under which a source may hold its rows, and its field aliases
RECORD_KEYS = ("items", "rows", "measurements", "values")
READING_ALIASES = {
    "site_id": ("site", "site_id"),
    "time": ("time", "date", "datetime"),
    "aqi": ("aqi",),
    "iaqi": ("iaqi",),
    "pm25": ("pm25",),
    "pm10": ("pm10",),
    "pm25_mcp": ("pm25_mcp",),
    "temperature": ("t", "temperature"),
    "humidity": ("h", "humidity"),
    "pressure": ("p", "pressure"),
}
SITE_ALIASES = {
    "site_name": ("name", "title"),
    "latitude": ("geom_y", "lat", "latitude"),
    "longitude": ("geom_x", "lon", "longitude"),
}
# end of fixed values


def _array_at(payload: Column, path: str) -> Column:
    return _as_array(F.get_json_object(payload, path))


def _as_array(text: Column) -> Column:
    """Elements of a JSON array as text; null when the text is no array."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))


def records(
    payloads: DataFrame, payload: str, keep: Sequence[str] = (), root: str = "data", keys: Sequence[str] = RECORD_KEYS
) -> DataFrame:
    """One row per record with its unparsed text in ``_raw`` and its place in ``record_no``.

    The records are the array at ``root``, or the first array under one of ``keys`` below it. Each
    level is parsed once and its members kept as text, in a projection of its own. A payload without a
    record array yields no rows.
    """
    outer = payloads.select(*keep, F.from_json(payload, f"`{root}` string")[root].alias("_body"))
    inner = outer.withColumn("_members", F.from_json("_body", ", ".join(f"`{k}` string" for k in keys)))
    texts = F.array("_body", *[F.col("_members")[k] for k in keys])
    first = F.get(F.filter(texts, lambda text: F.ltrim(text).startswith("[")), F.lit(0))
    return inner.select(*keep, F.posexplode(F.from_json(first, "array<string>")).alias("record_no", "_raw"))


def first_present(record: Column, names: Sequence[str]) -> Column:
    return F.coalesce(*[record[name] for name in names])


def resolve_aliases(
    rows: DataFrame, raw: str, aliases: dict[str, Sequence[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Text columns under their canonical names; the first alias that is not null counts."""
    names = list(dict.fromkeys(n for group in aliases.values() for n in group))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = rows.withColumn("_record", F.from_json(raw, schema))
    return parsed.select(
        *keep, *[first_present(F.col("_record"), group).alias(name) for name, group in aliases.items()]
    )


def keep_raw(df: DataFrame, name: str = "_raw", columns: Sequence[str] | None = None) -> DataFrame:
    """Add the row itself as JSON text, nulls included."""
    return df.withColumn(name, F.to_json(F.struct(*(columns or ["*"])), {"ignoreNullFields": "false"}))


def parallel_arrays(
    payloads: DataFrame, payload: str, variables: Sequence[str], root: str = "hourly", time: str = "time",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per element of ``root.time``; a short or missing array gives null."""
    arrays = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in [time, *variables]])
    parsed = payloads.select(*keep, F.from_json(F.get_json_object(payload, f"$.{root}"), arrays).alias("_a"))
    empty = F.array().cast("array<string>")
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_a.{n}"), empty).alias(n) for n in [time, *variables]])
    upto_time = F.slice(zipped, 1, F.size(f"_a.{time}"))
    rows = parsed.where(F.col(f"_a.{time}").isNotNull()).select(
        *keep, F.posexplode(upto_time).alias("row_no", "_row")
    )
    return rows.select(*keep, "row_no", *[F.col(f"_row.{n}").alias(n) for n in [time, *variables]])


def site_dimension(projects: DataFrame, site_payloads: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Sites of all projects, one row each.

    ``projects`` has ``payload`` with the project list, ``site_payloads`` has ``project_id`` and
    ``payload`` with the sites of that project. ``ids`` limits the sites to those it names.
    """
    project = "struct<id:string,name:string,short_name:string>"
    listed = (
        projects.select(F.explode(_array_at(F.col("payload"), "$.data")).alias("_p"))
        .select(F.from_json("_p", project).alias("_p"))
        .select(
            F.col("_p.id").alias("project_id"),
            F.col("_p.name").alias("project_name"),
            F.col("_p.short_name").alias("project_short_name"),
        )
        .where(F.col("project_id").isNotNull())
    )
    sites = site_payloads.select(
        F.col("project_id").cast("string").alias("project_id"),
        F.explode(_array_at(F.col("payload"), "$.data.sites")).alias("raw_json"),
    )
    flat = resolve_aliases(
        sites, "raw_json", {"site_id": ("id",), **SITE_ALIASES}, keep=["project_id", "raw_json"]
    )
    flat = flat.withColumn("site_id", F.col("site_id").try_cast("int")).where(F.col("site_id").isNotNull())
    if ids is not None:
        flat = keep_ids(flat, ids, "site_id")
    return flat.join(listed, "project_id").select(
        "site_id", "site_name", F.col("project_id").try_cast("int").alias("project_id"), "project_name",
        "project_short_name", F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"), "raw_json",
    )
