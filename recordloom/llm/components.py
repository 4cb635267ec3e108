"""Connected components of links, by alternating large and small stars.

Each task first replaces the links it reads by stars with the same components.
Unless stars of several tasks share nodes, that is all; else each round hooks the
neighbours of every node to their smallest one, task by task again and then across
tasks. A round is a few joins and aggregates of the links, written to the shared
folder, and the number of rounds grows with the logarithm of the longest path.
Sums are combined before they are shuffled and the joins are ones that adaptive
execution splits, so a node that most links share is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged

# Links that a task replaces by stars at once; its links are handed on in such lots.
LINKS = 100_000


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(hash(v, u))")).first())


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node but the smallest of each component of some links to that one."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def starred(size: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0

        def flushed() -> pa.RecordBatch:
            u, v = stars(np.concatenate(us), np.concatenate(vs))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            us.append(batch.column("u").to_numpy())
            vs.append(batch.column("v").to_numpy())
            n += batch.num_rows
            if n >= size:
                yield flushed()
                us, vs, n = [], [], 0
        if n:
            yield flushed()

    return rows


def _contracted(links: DataFrame, n: int, size: int) -> DataFrame:
    """Links with the same components, as stars of what a task reads of ``n`` links."""
    few = links.coalesce(max(1, -(-n // size))).mapInArrow(starred(size), "u long, v long")
    return staged(few.distinct() if n > size else few, "links")


def _open(links: DataFrame) -> bool:
    """Whether any node is linked to several smaller ones, or to one that is itself linked to a smaller one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return bool(ends.where("down + up > 1").agg(F.count("*")).first()[0])


def components(links: DataFrame, a: str = "a", b: str = "b", size: int = LINKS) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, for every linked node but that one."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    links = staged(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = _contracted(links, mark[0], size)
        # So few links were one lot of one task.
        if mark[0] <= size or not _open(links):
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join deals out both its sides itself and can split a hot node.
        least = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "links")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "links")
        smallest = staged(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = staged(small.union(smallest).distinct(), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
