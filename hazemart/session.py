"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a sort-merge join with a hot key is split even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No operator carries a broadcast hint: the planner broadcasts only a side whose size,
    # estimated from files or measured by AQE, stays below these limits.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # window and deduplication state lives on local disk with changes in the checkpoint, not on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "hazemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="hazemart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; no two calls share one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_open_spaces: list[list[str]] = []


@contextlib.contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Removes what :func:`settled` wrote inside the block once the block is left.

    For a job whose results are written by then; a frame that is still to be read must not leave it.
    """
    _open_spaces.append([])
    try:
        yield
    finally:
        for path in _open_spaces.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a reduced frame that several branches of a plan read: Spark prunes each branch on its own
    and would otherwise compute it, base table scan included, once per branch. The files also cut
    the lineage, so a lost executor costs a read.
    """
    path = scratch_path(df.sparkSession, label)
    if _open_spaces:
        _open_spaces[-1].append(path)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._settled_path = path
    return stored


def release(*frames: DataFrame | None) -> None:
    """Removes the files of frames that :func:`settled` returned, once nothing that is still to be run reads them."""
    for df in frames:
        path = getattr(df, "__dict__", {}).get("_settled_path")
        if path is not None:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
