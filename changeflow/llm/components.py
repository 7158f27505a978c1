"""Connected components of a graph of links, as joins and groupings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.scratch import written


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a star per component of the given links, each node at most once."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        for end in (a, b):
            np.minimum.at(after, end, least)
            np.minimum.at(after, label[end], least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _smallest_neighbour(both: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours; summed before the shuffle, so that a
    node with a third of all links is one row per task."""
    return both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest_neighbour(both), "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node with a link; the component is the least node reachable.

    ``links`` has two columns of ids; nulls and links to oneself are ignored. Rounds of large
    and small stars go on until nothing changes; their number grows with the logarithm of
    the graph. Each is written to the shared folder. No node's links ever meet in one task
    other than as rows of a join that Spark can split. An empty graph gives an empty result.
    """
    a, b = links.columns
    now = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    now, state = written(now, label), None
    while True:
        after = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v")))
        after = tuple(after.first())
        if after == state or not after[0]:
            break
        state = after
        now = written(_small_star(_large_star(now)), label)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
