"""Distributed connected components: alternating large-star and small-star.

Edges stay in Spark throughout; each round is written to the shared checkpoint
folder.  Before the first round every partition shrinks its edges to a
spanning forest.  A node with very many neighbours is joined by keys that AQE
may split, and its minimum is pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged


def star_forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reached) of every node that is not its own smallest, over the given edges."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(ends[: len(left)].tolist(), ends[len(left) :].tolist()):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(nodes))], np.int64) if len(nodes) else np.zeros(0, np.int64)
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = star_forest(batch.column("a").to_numpy(zero_copy_only=False), batch.column("b").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _smaller_per_node(edges: DataFrame) -> DataFrame:
    """The least neighbour of each ``a``."""
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns ``a`` and ``b``.  Returns (node, root) for
    every node of an edge whose component has a smaller node, root being the
    component's smallest; other nodes are their own root."""
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    edges = staged(edges.mapInArrow(_shrink, "a long, b long"), "edges")
    before = None
    while True:
        # a > b in every edge.  Large-star: neighbours above a node move to its least neighbour (or itself).
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _smaller_per_node(both).withColumn("least", F.least("a", "least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # Small-star: a node's smaller neighbours, and itself, move to the least of them.
        low = _smaller_per_node(large)
        moved = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
        edges = staged(moved.select("e.*").where("a > b").distinct(), "edges")
        # sums of bounded hashes: ids may be of any size, and a sum of them need not fit a long
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.xxhash64("b", "a") % 998244353)).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
