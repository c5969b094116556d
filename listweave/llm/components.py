"""Connected components by alternating large-star and small-star steps, all on executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import checkpointed, ship

#: Up to this many edges (two longs each) one task takes the rounds that are left.
TASK_EDGES = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what ``a``-``b`` connect.

    Used within a task: a clique of k nodes leaves k-1 edges.
    """
    if not len(a):
        return a[:0], b[:0]
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) stars of all edges of a task."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if parts:
        u, v = forest(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        for i in range(0, len(u), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 10_000]), pa.array(v[i : i + 10_000])], names=["u", "v"])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Each round is a large-star and a small-star step; the edges halve their depth, so the rounds are
    about log2 of the longest path.  A hub's neighbours meet only in a partial minimum and in a join
    that adaptive execution can split.  Once no more than ``TASK_EDGES`` edges are there, one task takes
    the rest of the rounds in memory.  Self-loops and repeated edges are allowed; nulls drop out; an
    empty input gives an empty result.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = checkpointed(e.where("u is not null and v is not null and u <> v").distinct())

    def mark(d: DataFrame) -> tuple:
        row = d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row.n, row.h

    before = mark(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        if before[0] <= TASK_EDGES:
            ship(edges.sparkSession)
            e = checkpointed(e.select("u", "v").coalesce(1).mapInArrow(_whole, "u long, v long"))
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
