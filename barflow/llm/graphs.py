"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from barflow.session import stage

ROUNDS = 60


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node number in the component of each of n nodes, for edges held in memory."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label != label[label]).any():
            label = label[label]


def _state(edges: DataFrame):
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _nearest(edges: DataFrame, low) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("_v")).select(F.col("u").alias("_u"), low.alias("m"))
    return edges.join(least, F.col("u") == F.col("_u"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, root being the smallest node it is connected to.

    ``edges`` has two columns of one type. Alternating star steps: every node hands its larger, then its
    smaller neighbours to its smallest one, until all edges end at roots. Each round is written to the shared
    folder and read again, so lost executors repeat one round at most and nothing is kept on the driver.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    current = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current = stage(current, "edges")
    state = _state(current)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both, F.least("_v", "u")).where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _nearest(large, F.col("_v"))
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = stage(small.where("u <> v").distinct(), "edges")
        before, state = state, _state(current)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
