"""Small things on the cluster's file system: markers, listings and removals, by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing where there is no folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place))


def claim(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates the file and says whether it was this call that did; of two callers one succeeds."""
    system, place = _place(spark, path)
    try:
        out = system.create(place, False)
    except Exception as refused:
        if system.exists(place):
            return False
        raise refused
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
