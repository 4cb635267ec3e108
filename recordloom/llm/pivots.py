"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest pivots in order (nearest
first). The inverted lists hold vectors under every pair of these pivots, so a
list is short although pivots are few; vectors of one list share at least that
pair. Within a list the shared pivots of each pair of vectors are counted, the
pair is left to the list of the two smallest pivots it shares, and cosines are
verified in double precision. Long lists are compared block by block, and a
list gives out counts of links and a spanning forest, never its pairs.

Equal vectors of one label are one class, indexed once. The pivots are the only
sample: ``MIN_PIVOTS`` to ``MAX_PIVOTS`` of them, about a third of the root of
the number of classes, chosen by a hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import columns_of, staged
from recordloom.llm.components import components
from recordloom.llm.grouped import block_pairs, by_group, pairs_of_group, spanning

COSINE = 0.93
NEAREST = 6
SHARED = 2
MIN_PIVOTS, MAX_PIVOTS = 48, 4096
KEY_BASE = 1 << 13


def vectors(packed: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision."""
    return np.frombuffer(b"".join(packed), dtype="<f8").reshape(len(packed), -1)


def prepared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles of unit length; none where nothing can be compared."""
    for batch in batches:
        packed: list[bytes | None] = []
        for values, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist()):
            usable = label is not None and bool(values) and None not in values
            x = np.array(values if usable else [], dtype=np.float64)
            if usable and np.isfinite(x).all() and (scale := np.abs(x).max()) > 0:
                x = x / scale
                packed.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
            else:
                packed.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())], ["vec_id", "label", "unit"]
        )


def permuted(pivots: dict[int, np.ndarray], nearest: int):
    """Adds the ordered nearest pivots to unit vectors; ``pivots`` by dimension."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            perms: list[list[int]] = [[] for _ in range(batch.num_rows)]
            units = batch.column("unit").to_pylist()
            sizes = np.array([len(u) // 8 for u in units])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                near = vectors([units[i] for i in at]) @ pivots[int(size)].T
                order = np.argsort(-near, axis=1, kind="stable")[:, :nearest]
                for i, perm in zip(at, order):
                    perms[i] = perm.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(perms, pa.list_(pa.int32()))], [*batch.schema.names, "perm"])

    return rows


def posted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pair of a vector's pivots, or for its one pivot."""
    for batch in batches:
        at, first, second = [], [], []
        for i, perm in enumerate(batch.column("perm").to_pylist()):
            for p, q in combinations(sorted(perm), 2) if len(perm) > 1 else [(p, p) for p in perm]:
                at.append(i)
                first.append(p)
                second.append(q)
        pick = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("rep").take(pick), batch.column("label").take(pick), batch.column("size").take(pick),
                pa.array(np.array(first, dtype=np.int64) * KEY_BASE + np.array(second, dtype=np.int64)),
            ],
            ["rep", "label", "size", "pair"],
        )


def compared(cosine: float, shared: int):
    """Verifies the pairs that belong to a list: counts of links per vector, and edges of a spanning forest."""

    def perms_of(column: pa.ChunkedArray) -> np.ndarray:
        """The nearest pivots, one row per vector, filled up with numbers that match nothing."""
        lists = column.to_pylist()
        out = np.full((len(lists), max(map(len, lists))), -1, dtype=np.int64)
        for i, perm in enumerate(lists):
            out[i, : len(perm)] = perm
        return out

    def own(left: np.ndarray, right: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Whether pairs share enough pivots and this list is that of the two smallest."""
        common = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)
        count = common.sum(axis=(1, 2))
        p, q = np.divmod(pair, KEY_BASE)
        below = (common & (left < q[:, None])[:, :, None]).sum(axis=(1, 2))
        enough = np.minimum(shared, np.minimum((left >= 0).sum(axis=1), (right >= 0).sum(axis=1)))
        return (count >= enough) & (below == (p != q))

    def result(ids, counts, a, b) -> pa.RecordBatch | None:
        some = np.flatnonzero(counts)
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], a])), pa.array([None] * len(some) + b.tolist(), pa.int64()),
                pa.array(np.concatenate([counts[some], np.zeros(len(a), np.int64)])),
            ],
            ["a", "b", "links"],
        )

    def handle(group: pa.Table) -> pa.RecordBatch | None:
        ids = group.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        units = vectors(group.column("unit").to_pylist())[order]
        copies = group.column("n").to_numpy()[order]
        near = units @ units.T
        x, y = np.nonzero(np.triu((near >= cosine) & pairs_of_group(group, order), 1))
        perms = perms_of(group.column("perm"))[order]
        keep = [
            own(perms[x[s : s + 20_000]], perms[y[s : s + 20_000]], np.full(len(x[s : s + 20_000]), group.column("pair")[0].as_py()))
            for s in range(0, len(x), 20_000)
        ]
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        x, y = x[keep], y[keep]
        counts = np.bincount(x, copies[y], minlength=len(ids)) + np.bincount(y, copies[x], minlength=len(ids))
        weights = np.zeros((len(ids), len(ids)))
        weights[x, y] = weights[y, x] = near[x, y]
        edges = np.array(spanning(weights, ids), dtype=np.int64).reshape(-1, 2)
        return result(ids, counts.astype(np.int64), ids[edges[:, 0]], ids[edges[:, 1]])

    def many(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
        ids, copies, block = (rows.column(c).to_numpy() for c in ("rep", "n", "own"))
        within = rows.column("i").to_numpy()[left] == rows.column("j").to_numpy()[left]
        apart = within | (block[left] != block[right])
        left, right = left[apart], right[apart]
        packed = rows.column("unit").to_pylist()
        sizes = np.array([len(u) for u in packed])
        perms = perms_of(rows.column("perm"))
        first, second = [left[:0]], [left[:0]]
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            place = np.zeros(len(sizes), dtype=np.int64)
            place[at] = np.arange(len(at))
            units = vectors([packed[i] for i in at])
            mine = np.flatnonzero(sizes[left] == size)
            for start in range(0, len(mine), 20_000):
                x, y = left[mine[start : start + 20_000]], right[mine[start : start + 20_000]]
                near = (units[place[x]] * units[place[y]]).sum(axis=1) >= cosine
                x, y = x[near], y[near]
                keep = own(perms[x], perms[y], rows.column("pair").to_numpy()[x])
                first.append(x[keep])
                second.append(y[keep])
        x, y = np.concatenate(first), np.concatenate(second)
        counts = np.bincount(x, copies[y], minlength=len(ids)) + np.bincount(y, copies[x], minlength=len(ids))
        return result(ids, counts.astype(np.int64), ids[x], ids[y])

    return handle, many


def near_vectors(
    vecs: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, pivots: int | None = None,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row (``vec_id``, ``embedding``, ``label``).

    Vectors are compared within a label. A null, empty or zero vector, one with
    a null or non-finite component and one without a label have no links and are
    components of their own; so are vectors of different lengths to each other.
    Repeated rows count as vectors of their own; rows without an id count as
    links of others, but have no component (null). Other columns are ignored.
    """
    spark = vecs.sparkSession
    rows = columns_of(vecs, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label")
    )
    units = staged(
        rows.mapInArrow(prepared, "vec_id long, label string, unit binary").withColumns(
            {"h1": F.xxhash64("label", "unit"), "h2": F.xxhash64("unit", F.lit(1), "label")}
        ),
        "units",
    )
    usable = units.where("unit IS NOT NULL")
    classes = usable.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("unit").alias("unit"), F.first("label").alias("label")
    )
    # A class without any id is known by its hash, below all ids.
    hidden = -F.pmod("h1", F.lit(1 << 62)) - F.lit(1 << 62)
    classes = staged(classes.withColumn("rep", F.coalesce("id", hidden)), "vector-classes")
    total = classes.count()
    wanted = pivots or int(min(MAX_PIVOTS, max(MIN_PIVOTS, np.sqrt(total) / 3)))
    sample = [bytes(r[0]) for r in classes.orderBy("h2").select("unit").limit(4 * wanted).collect()]
    by_size: dict[int, list[bytes]] = {}
    for unit in sample:
        if len(by_size.setdefault(len(unit) // 8, [])) < wanted:
            by_size[len(unit) // 8].append(unit)
    for (size,) in classes.select((F.length("unit") / 8).cast("int")).distinct().collect():
        if size not in by_size:
            of_size = classes.where(F.length("unit") == size * 8).orderBy("h2").select("unit").limit(wanted)
            by_size[size] = [bytes(r[0]) for r in of_size.collect()]
    chosen = {size: vectors(units_of) for size, units_of in by_size.items()}
    known = classes.select("rep", "label", "n", F.length("unit").alias("size"), "unit")
    indexed = staged(
        known.mapInArrow(permuted(chosen, nearest), "rep long, label string, n long, size int, unit binary, perm array<int>"), "perms"
    )
    posts = indexed.select("rep", "label", "size", "perm").mapInArrow(posted, "rep long, label string, size int, pair long")
    posts = posts.withColumn("key", F.xxhash64("label", "size", "pair"))
    # Stored, so that the join deals out both its sides itself and can split a long list.
    lengths = staged(posts.groupBy("key").agg(F.count("*").alias("length")).where("length > 1"), "lengths")
    members = posts.join(lengths, "key").select("key", "pair", "length", "rep")
    members = members.join(indexed.select("rep", "n", "unit", "perm"), "rep")
    found = staged(
        block_pairs(members, "length", "rep").mapInArrow(by_group(*compared(cosine, shared)), "a long, b long, links long"), "vector-links"
    )
    others = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("others"))
    linked = components(found.where("b IS NOT NULL")).withColumnRenamed("node", "rep")
    placed = classes.select("h1", "h2", "rep", "id", "n").join(others, "rep", "left").join(linked, "rep", "left")
    whole = F.coalesce("component", "rep")
    # The smallest real id of a component whose smallest member has none.
    smallest = placed.groupBy(whole.alias("whole")).agg(F.min("id").alias("component_id"))
    placed = placed.withColumn("whole", whole).join(smallest, "whole")
    placed = placed.select("h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = units.where("unit IS NOT NULL").select("vec_id", "h1", "h2").join(placed, ["h1", "h2"])
    alone = units.where("unit IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = out.select("vec_id", "n_links", "component_id").union(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
