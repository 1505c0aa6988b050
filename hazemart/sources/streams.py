"""Stream scans. Every one yields a ``value`` column holding one JSON event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_events(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **options: str
) -> DataFrame:
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting_offsets is earliest or latest")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def text_events(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Replay of a folder with one JSON event per line."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select(F.col("value").cast("binary").alias("value"))


def table_events(spark: SparkSession, folder: str, file: str, schema) -> DataFrame:
    """A Parquet table of ``folder`` read as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)
