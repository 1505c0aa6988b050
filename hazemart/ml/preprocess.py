"""Splitting, imputation, scaling and text weights."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.ml.feature import IDF, HashingTF, Imputer, SQLTransformer, Tokenizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart.config import ModelSettings


def in_training_share(key: Column, percent: int = 80) -> Column:
    """Deterministic split by a whole-number key: the same rows on any partitioning.

    The key is first brought below 2**31, so that the product stays inside a long.
    """
    small = F.pmod(key.cast("long"), F.lit(2147483647))
    return F.pmod(small * F.lit(2654435761), F.lit(100)) < percent


def row_key(*columns: str) -> Column:
    """Whole-number key of a row for :func:`in_training_share`."""
    return F.xxhash64(*columns)


def impute_mean(df: DataFrame, columns: Sequence[str], suffix: str = "_imp") -> DataFrame:
    """Nulls and NaNs replaced by the column mean, which reaches the rows as a scalar subquery."""
    known = {c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns}
    means = df.agg(*[F.avg(value).alias(c) for c, value in known.items()])
    return df.withColumns(
        {f"{c}{suffix}": F.coalesce(value, means.select(c).scalar()) for c, value in known.items()}
    )


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """(x - mean) / sample deviation; a constant column gives 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    )

    def scaled(c: str) -> Column:
        spread = stats.select(f"s_{c}").scalar()
        shifted = F.col(c) - stats.select(f"m_{c}").scalar()
        return F.when(spread == 0, F.lit(0.0)).otherwise(F.try_divide(shifted, spread))

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def tokens(text: Column) -> Column:
    """Lower-cased text split at single blanks, as Spark ML's Tokenizer does.

    Empty tokens at the end vanish, and '' itself gives one empty token.
    """
    # the pattern \s+$ takes longer, and stops before a last line separator beyond ASCII
    body = F.rtrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(body, r"\s"))


def _each(values: Column, name: str, *keep: str) -> Callable[[DataFrame], DataFrame]:
    """One row for each of ``values``, none of which is null.

    Spark infers that the array of an explode is not empty, and computes it once more at the scan to see that; of an outer one it does not.
    """
    return lambda df: df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """Exact-vocabulary term weights: tf * ln((documents + 1) / (document frequency + 1)).

    ``key`` is unique, one row per document. The document frequency therefore needs no grouping by
    document: it counts the distinct terms of each row, combined on the map side, so only the
    vocabulary is shuffled however often a term occurs. The texts are dealt by key before they are cut into
    terms, so the counts of a document are complete where it lies, and only the join exchanges them; it
    hashes the vocabulary, of which every term is one row, and need not sort the counts. Counting terms inside
    the row, as runs of its sorted tokens, takes twice the time: 32 s against 15 s at sf0.1.
    """
    terms = tokens(F.col(text))
    # by number, since packed texts look small, and would be joined to partitions whose terms do not fit in memory
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(key, text).repartition(parts, key)
    counts = dealt.transform(_each(terms, "term", key)).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    frequency = df.transform(_each(F.array_distinct(terms), "term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.join(frequency.hint("shuffle_hash"), "term").select(
        key, "term", "tf", "df", (F.col("tf") * F.log((documents + 1) / (F.col("df") + 1))).alias("tfidf")
    )


def hash_bucket(term: Column, buckets: int) -> Column:
    """Bucket of a term by the first 32 bits of its digest."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def tfidf_hashed(df: DataFrame, key: str, text: str, buckets: int = ModelSettings.text_dims) -> DataFrame:
    """Term weights of a fixed number of buckets: (key, bucket, tf, df, tfidf), without the buckets a document leaves empty.

    tf sums the terms of a bucket, df counts the documents that have any of them. ``key`` is unique, so the
    counts are complete on the map side: at most ``buckets`` rows of a document are exchanged, and for the
    document frequency one row of a task and bucket.
    """
    placed = df.select(key, F.transform(tokens(F.col(text)), lambda term: hash_bucket(term, buckets)).alias("_buckets"))
    counts = placed.transform(_each(F.col("_buckets"), "bucket", key)).groupBy(key, "bucket").agg(F.count(F.lit(1)).alias("tf"))
    frequency = placed.transform(_each(F.array_distinct("_buckets"), "bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.join(frequency, "bucket").select(
        key, "bucket", "tf", "df", (F.col("tf") * F.log((documents + 1) / (F.col("df") + 1))).alias("tfidf")
    )


def hashed_vectors(weights: DataFrame, key: str, buckets: int = ModelSettings.text_dims) -> DataFrame:
    """(key, text_features): the rows of :func:`tfidf_hashed` as one array a document, 0 for empty buckets."""
    entries = F.map_from_entries(F.collect_list(F.struct("bucket", "tfidf")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.coalesce(F.col("_weights")[b], F.lit(0.0)))
    return weights.groupBy(key).agg(entries.alias("_weights")).select(key, filled.alias("text_features"))


def text_stages(text: str, output: str, dims: int) -> list:
    return [
        Tokenizer(inputCol=text, outputCol=f"{output}_tokens"),
        HashingTF(inputCol=f"{output}_tokens", outputCol=f"{output}_tf", numFeatures=dims),
        IDF(inputCol=f"{output}_tf", outputCol=output),
    ]


def unknown_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that hold no value at all; there is no mean of those."""
    counts = df.agg(*[F.count(F.nullif(F.col(c).cast("double"), F.lit(float("nan")))).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] == 0]


def require_known_values(df: DataFrame, columns: Sequence[str]) -> None:
    """Name the columns that hold no value at all; a mean cannot be taken of those."""
    empty = unknown_columns(df, columns)
    if empty:
        raise ValueError(f"no value to take a mean of in: {', '.join(empty)}")


def imputing_stages(columns: Sequence[str], suffix: str, unknown: Sequence[str] = ()) -> list:
    """Stages that add ``column + suffix``: the mean for what is missing, 0 in every row for the ``unknown`` columns.

    A constant column has no part in any fit: its weight is 0, no tree splits at it and it adds nothing to a distance. It keeps its place
    among the features, so their number and names stay the same. Columns must be double: an integer mean is truncated.
    """
    known = [c for c in columns if c not in unknown]
    stages = [Imputer(inputCols=known, outputCols=[f"{c}{suffix}" for c in known], strategy="mean")] if known else []
    if unknown:
        warnings.warn(f"no value to take a mean of, so without influence: {', '.join(unknown)}", stacklevel=2)
        constants = ", ".join(f"0.0D AS `{c}{suffix}`" for c in unknown)
        stages.append(SQLTransformer(statement=f"SELECT *, {constants} FROM __THIS__"))
    return stages


def supervised_stages(settings: ModelSettings, text: str = "announcement_text", unknown: Sequence[str] = ()) -> list:
    """Imputer, text weights and assembler; ``unknown`` names the features without any value."""
    imputed = [f"{c}_imp" for c in settings.features]
    return [
        *imputing_stages(settings.features, "_imp", unknown),
        *text_stages(text, "text_features", settings.text_dims),
        VectorAssembler(inputCols=[*imputed, "text_features"], outputCol="features", handleInvalid="keep"),
    ]


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
