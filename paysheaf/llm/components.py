"""Connected components of a table of links, by alternating stars over Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Links that a task contracts at once (16 bytes each).
BLOCK = 250_000


def contract(pairs: np.ndarray) -> np.ndarray:
    """Links (u, v) of one block, replaced by links of every node to the smallest node it reaches here."""
    nodes, at = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))
    for a, b in at.reshape(-1, 2).tolist():
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        parent[max(a, b)] = min(a, b)
    for k in range(len(parent)):
        parent[k] = parent[parent[k]]
    root = np.array(parent, dtype=np.int64)
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]], axis=1)


def _contracted(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 2), np.int64)
        for batch in batches:
            more = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1)
            held = np.concatenate([held, more])
            if len(held) >= BLOCK:
                small = contract(held)
                if len(small) > BLOCK // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(small[:, 0]), pa.array(small[:, 1])], names=["u", "v"])
                    small = small[:0]
                held = small
        if len(held):
            held = contract(held)
            yield pa.RecordBatch.from_arrays([pa.array(held[:, 0]), pa.array(held[:, 1])], names=["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long, not null). Returns node, component for every node that reaches a smaller one.

    Each round first contracts what a task holds, then links all larger neighbours of a node to its
    smallest one, and all smaller neighbours likewise, until nothing changes. When the links that are
    left fit one block, a last contraction of that block finishes at once.
    """
    now = stored(_contracted(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "links")
    before = None
    while True:
        if now.count() <= BLOCK:
            now = _contracted(now.repartition(1))
            return stored(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "components")
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(stored(least, "least"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        up = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(_contracted(up.union(least.select("u", F.col("m").alias("v"))).distinct()), "links")
        mark = _mark(now)
        if mark == before or not mark[0]:
            break
        before = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
