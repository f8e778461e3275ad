"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctag.llm.registry import durable
def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``: the smallest node that
    can be reached. Nodes can be of any ordered type.

    Large and small stars take turns: every node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows. Each round is a partial minimum
    per node and a join, and is stored, so a lost executor costs one round at most.
    A node with very many links is split by Spark's handling of skewed joins; no
    node's links are ever gathered. The number of rounds grows with the logarithm of
    the longest chain."""
    edges = durable(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every node keeps its link to the smallest node it knows.
        large = large.unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))
        large = durable(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For the nodes 0 .. n - 1 of a task, the smallest node that the links reach."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        label = new[label]
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label
