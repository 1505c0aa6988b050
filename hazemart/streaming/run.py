"""Starting queries and reading what they wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazemart.config import StreamSettings
from hazemart.sources import files
from hazemart.sources.sinks import parquet_batch_sink


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    settings: StreamSettings = StreamSettings(),
    available_now: bool = True,
) -> StreamingQuery:
    """Feed every micro-batch to ``sink``. Progress lives in ``checkpoint``: the same folder
    resumes, a new one starts over.

    Modes ``update`` and ``append`` drop rows later than the watermark and forget closed windows;
    ``complete`` keeps every window and hands the whole snapshot over at each trigger. A reset of this progress
    that was interrupted is finished first.
    """
    finish_reset(df.sparkSession, checkpoint)
    writer = df.writeStream.outputMode(settings.output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": settings.trigger_interval}
    return writer.trigger(**trigger).start()


def _intent(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.reset"


def reset(spark: SparkSession, checkpoint: str, *outputs: str) -> None:
    """Removes the progress of a stopped stream together with what it wrote, so that the next start begins anew.

    What is to go is noted beside the checkpoint first. If the driver is lost on the way, the next start (or reset) completes
    the removal, so a stream never resumes with a part of its output missing or starts over on top of the rest.
    """
    note = "\n".join([*(o.rstrip("/") for o in outputs), checkpoint.rstrip("/")])
    if not files.claim(spark, _intent(checkpoint), note):
        finish_reset(spark, checkpoint)
        files.claim(spark, _intent(checkpoint), note)
    finish_reset(spark, checkpoint)


def finish_reset(spark: SparkSession, checkpoint: str) -> bool:
    """Completes a reset that was begun; whether there was one."""
    if not files.exists(spark, _intent(checkpoint)):
        return False
    for path in files.read(spark, _intent(checkpoint)).splitlines():
        files.remove(spark, path)
    files.remove(spark, _intent(checkpoint))
    return True


def drain_to_parquet(
    df: DataFrame, path: str, settings: StreamSettings = StreamSettings(), checkpoint: str | None = None
) -> None:
    """Process what is available and leave one folder per micro-batch under ``path``."""
    start(df, parquet_batch_sink(path), checkpoint or f"{path}-progress", settings).awaitTermination()


def latest_windows(spark: SparkSession, path: str, output_mode: str = "update") -> DataFrame:
    """State of all windows from the micro-batch folders of :func:`drain_to_parquet`."""
    batches = spark.read.parquet(path)
    if output_mode == "complete":
        return batches.where(F.col("batch_id") == batches.agg(F.max("batch_id")).scalar()).drop("batch_id")
    if output_mode == "append":
        return batches.drop("batch_id")
    newest = Window.partitionBy("window_start", "site_id", "site_name").orderBy(F.col("batch_id").desc())
    return batches.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "batch_id")
