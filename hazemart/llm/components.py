"""Connected components and spanning forests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemart.session import release, settled


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    With ``rounds`` it stops early: equal labels still mean connected, different ones not yet that they are apart.

    Each round a node takes the smallest label among its own and its neighbours', then the label of that
    label, so paths halve. A round is written to the shared folder. The smallest label is a map-side
    aggregate, so a node with very many links costs one row per task.
    """
    links = edges.where(F.col("a") != F.col("b"))
    both = settled(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a"))), "links"
    )
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    labels = stored = settled(labels.withColumn("component", F.least("node", "component")), "labels")
    done = 0
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "component"), "v").select(F.col("u").alias("node"), "component")
        own = labels.withColumn("old", F.col("component"))
        least = own.unionByName(near, allowMissingColumns=True).groupBy("node").agg(
            F.min("component").alias("label"), F.max("old").alias("old")
        )
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("component"))
        moved = settled(least.join(jump, "label").select("node", "component", "old"), "labels")
        release(stored)
        stored, labels = moved, moved.select("node", "component")
        done += 1
        if done == rounds or not moved.where(F.col("component") != F.col("old")).limit(1).count():
            release(both)
            return stored.select("node", "component")


def forest(first: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    """Smallest index reachable from each of ``count`` indexes over the given links."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[first], label[second])
        before = label.copy()
        np.minimum.at(label, first, low)
        np.minimum.at(label, second, low)
        np.minimum.at(label, before[first], low)
        np.minimum.at(label, before[second], low)
        label = label[label]
        if np.array_equal(label, before):
            return label
