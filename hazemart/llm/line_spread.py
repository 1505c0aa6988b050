"""Removal of boilerplate lines by the number of distinct sites they appear on.

Lines become 128-bit hashes once. A line seen on one site only never needs a sketch; for the others a
HyperLogLog sketch of sites per line hash is built on the map side and merged by aggregation. A
sketch decides alone where its estimate is far from the threshold; lines near it get an exact
distinct count. All of it is built-in Spark: a line that stands in a third of all rows costs one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart.session import settled

MIN_SITES = 5
#: 1: every line that is not blank
MIN_CHARS = 1
SKETCH_BITS = 12
#: sketches within this factor of the threshold are counted exactly; far wider than their error
NEAR = 2


def _parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    """128 bits, so that no two of a large corpus's lines are taken for one."""
    key = F.trim(line)
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _counted(line: Column, min_chars: int) -> Column:
    return F.length(F.trim(line)) >= min_chars if min_chars > 1 else line.rlike(r"\S")


def line_sites(docs: DataFrame, min_chars: int, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Distinct (_id, _site, _line) of the lines with ``min_chars`` characters or more, by default all that are not blank."""
    long_enough = F.filter(_parts(F.col(text_col)), lambda line: _counted(line, min_chars))
    hashes = F.array_distinct(F.transform(long_enough, _hash))
    site = F.when(F.col(site_col).isNotNull(), F.xxhash64(F.col(site_col)))
    return docs.select(F.col(id_col).alias("_id"), site.alias("_site"), F.explode(hashes).alias("_line"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The lines on ``min_sites`` or more distinct sites: _line and _first, the smallest id that has it."""
    several = (
        lines.groupBy("_line")
        .agg(F.min("_site").alias("low"), F.max("_site").alias("high"), F.min("_id").alias("_first"))
        .where(F.col("low") < F.col("high") if min_sites > 1 else F.col("low").isNotNull())
        .select("_line", "_first")
    )
    several = settled(several, "lines-several")
    seen = lines.join(several.select("_line"), "_line", "left_semi")
    spread = settled(
        seen.groupBy("_line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", SKETCH_BITS)).alias("about")), "lines-sketch"
    )
    near = spread.where(F.col("about").between(min_sites // NEAR, min_sites * NEAR)).select("_line")
    exact = (
        lines.join(near, "_line", "left_semi").where(F.col("_site").isNotNull()).select("_line", "_site").distinct()
        .groupBy("_line").count().where(F.col("count") >= min_sites).select("_line")
    )
    sure = spread.where(F.col("about") > min_sites * NEAR).select("_line")
    return several.join(sure.union(exact), "_line", "left_semi")


def remove_spread_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS,
    id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, plus n_lines and n_removed.

    A line (outer spaces aside) of at least ``min_chars`` characters, by default any that is not blank, that stands on ``min_sites`` or
    more distinct sites stays in the document with the smallest id that has it and goes from all
    others. A null site counts as no site. Null text stays null and has 0 lines, an empty text has
    one empty line. Rows with equal ids are treated alike; a row with a null id takes part in the
    counts and is returned unchanged. All columns are kept; columns named n_lines or n_removed are
    replaced. An empty table gives no rows.
    """
    lines = settled(line_sites(docs, min_chars, id_col, text_col, site_col), "lines")
    spread = spread_lines(lines, min_sites)
    own_id, own_lines = _unused(docs, "_id"), _unused(docs, "_gone")
    # a document has each line once, so its array is no longer than its text
    gone = (
        lines.join(spread, "_line").where(F.col("_id") != F.col("_first"))
        .groupBy(F.col("_id").alias(own_id)).agg(F.collect_set("_line").alias(own_lines))
    )
    parts = _parts(F.col(text_col))
    kept = F.filter(parts, lambda line: ~_counted(line, min_chars) | ~F.array_contains(F.col(own_lines), _hash(line)))
    joined = docs.drop("n_lines", "n_removed").join(gone, F.col(id_col) == F.col(own_id), "left")
    hit = F.col(own_lines).isNotNull()
    n_lines = F.when(F.col(text_col).isNotNull(), F.size(parts)).otherwise(0).cast("long")
    n_removed = F.when(hit, F.size(parts) - F.size(kept)).otherwise(0).cast("long")
    out = [F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c)
           for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*out, n_lines.alias("n_lines"), n_removed.alias("n_removed"))
