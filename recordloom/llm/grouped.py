"""Lists cut into blocks, and pairs of blocks handled one at a time in numpy.

A list of any length is dealt to blocks of about ``BLOCK`` members; every pair
of blocks is one small group, so a long list becomes many groups on many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged

BLOCK = 512
SMALL = 16


def block_pairs(members: DataFrame, count: str, member: str, block: int = BLOCK) -> DataFrame:
    """The members of lists (column ``key``; ``count`` is the length) once for each pair of blocks
    that their block ``own`` is part of, grouped by ``key``, ``i`` and ``j`` within partitions."""
    blocks = F.ceil(F.col(count) / block).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(11)), blocks).cast("int")
    rows = members.withColumns({"own": own, "_other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    rows = rows.withColumns({"i": F.least("own", "_other"), "j": F.greatest("own", "_other")}).drop("_other", count)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def minority_pairs(members: DataFrame, member: str, heavy: int, block: int = BLOCK) -> DataFrame:
    """The members of lists (``key``, ``label``, ``weight``) dealt so that each two of different labels meet, grouped by ``key``, ``i`` and ``j``.

    In a list mostly of one label only the others, the minority, have to meet all
    members: blocks ``j`` of the minority (``minor``) against blocks ``i`` of
    the whole list, so that members of the majority are copied once a block of
    the minority. A block has about ``block`` members, of some ``heavy`` weight together.
    """
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    lists = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "label", "w")).alias("most"))
    blocks = lambda n, w: F.ceil(F.greatest(n / block, F.least(n, w / heavy))).cast("int")
    lists = lists.select(
        "key", F.col("most.label").alias("major"), blocks(F.col("n"), F.col("w")).alias("all"), blocks(F.col("n") - F.col("most.n"), F.col("w") - F.col("most.w")).alias("few")
    )
    # Stored, so that the join deals out both its sides itself and can split a long list.
    members, lists = members.drop("weight"), staged(lists, "lists")
    rows = members.join(lists, "key")
    own = F.xxhash64(member, F.lit(11))
    many = rows.select(*members.columns, F.lit(False).alias("minor"), F.pmod(own, "all").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("j"))
    rest = rows.where("label <> major").select(
        *members.columns, F.lit(True).alias("minor"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("i"), F.pmod(own, "few").cast("int").alias("j")
    )
    return in_groups(many.union(rest.select(*many.columns)))


def in_groups(rows: DataFrame) -> DataFrame:
    """Rows with those of one ``key``, ``i`` and ``j`` together."""
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def each_group(handle: Callable[[pa.Table], pa.RecordBatch | None]):
    """A function for ``mapInArrow`` over rows sorted by key, i and j, that hands on one run of equal rows at a time."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[pa.Table] = []
        last: tuple | None = None

        def finished() -> Iterator[pa.RecordBatch]:
            got = handle(pa.concat_tables(carried).combine_chunks()) if carried else None
            carried.clear()
            if got is not None and got.num_rows:
                yield got

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = np.column_stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                if last != tuple(keys[start]):
                    yield from finished()
                    last = tuple(keys[start])
                carried.append(table.slice(start, end - start))
        yield from finished()

    return rows


def pairs_of_group(group: pa.Table, order: np.ndarray) -> np.ndarray:
    """Which pairs of rows a group has to compare: all of one block, or those across two."""
    i, j = int(group.column("i")[0].as_py()), int(group.column("j")[0].as_py())
    side = group.column("own").to_numpy()[order] == i
    return np.ones((len(side), len(side)), dtype=bool) if i == j else side[:, None] != side[None, :]


def by_group(handle: Callable[[pa.Table], pa.RecordBatch | None], many: Callable[..., pa.RecordBatch | None]):
    """A function for ``mapInArrow`` over rows sorted by key, i and j.

    Runs of equal rows of more than ``SMALL`` rows go to ``handle`` one by one;
    ``many`` gets the small ones of a batch together, with the places of all
    pairs of rows of one run (``left``, ``right``).
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None

        def finished(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
            sizes = np.diff(cuts)
            for start, size in zip(cuts[:-1][sizes > SMALL], sizes[sizes > SMALL]):
                got = handle(table.slice(start, size))
                if got is not None and got.num_rows:
                    yield got
            keep = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
            if len(keep):
                run = np.repeat(np.arange(len(sizes)), sizes)[keep]
                at = np.arange(len(keep))
                pairs = [(at[:-d][run[:-d] == run[d:]], d) for d in range(1, min(SMALL, len(keep)))]
                left = np.concatenate([x for x, _ in pairs]) if pairs else at[:0]
                right = np.concatenate([x + d for x, d in pairs]) if pairs else at[:0]
                got = many(table.take(pa.array(keep)), left, right)
                if got is not None and got.num_rows:
                    yield got

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if carried is None else pa.concat_tables([carried, table])
            keys = np.column_stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
            yield from finished(table, cuts)
            carried = table.slice(cuts[-1])
        if carried is not None:
            yield from finished(carried, np.array([0, carried.num_rows]))

    return rows


def spanning(weights: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
    """Heaviest edges that connect what positive ``weights`` connect; equal ``labels`` count as connected."""
    n = len(labels)
    _, group = np.unique(labels, return_inverse=True)
    chosen: list[tuple[int, int]] = []
    while True:
        open_edges = np.where(group[:, None] != group[None, :], weights, 0)
        partner = open_edges.argmax(axis=1)
        best = open_edges[np.arange(n), partner].astype(np.float64)
        if best.max(initial=0) <= 0:
            return chosen
        # The heaviest edge of each group; ties go to the earliest pair, seen alike from both ends.
        low, high = np.minimum(np.arange(n), partner), np.maximum(np.arange(n), partner)
        order = np.lexsort((high, low, -best, group))
        first = order[np.unique(group[order], return_index=True)[1]]
        for x in first[best[first] > 0]:
            a, b = group[x], group[partner[x]]
            if a != b:
                chosen.append((int(x), int(partner[x])))
                group = np.where(group == max(a, b), min(a, b), group)
