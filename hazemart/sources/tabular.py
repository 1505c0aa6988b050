"""Text tables: every column arrives as a string, types are decided later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV with a header and doubled quotes. ``multi_line`` makes files unsplittable; keep it for notices."""
    return (
        spark.read.schema(text_schema(columns))
        .options(header=True, quote='"', escape='"', multiLine=multi_line)
        .csv(path)
    )


def read_integers(spark: SparkSession, path: str) -> DataFrame:
    """One integer per line; other lines give null."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("value"))
