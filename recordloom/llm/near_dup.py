"""MinHash near-dedup by a signature-coordinate inverted join.

Documents with equal shingle sets form a class; one of each goes on. A document
is posted under each pair of coordinate and value of its signature. Similar
documents agree in at least ``needed(percent)`` of ``COORDINATES`` coordinates,
so it is enough to look for partners in the rarest lists, one more than the
coordinates they may differ in (prefix); values nobody else has come first among these, hence most documents
have no list left, and the long lists of common passages are the last anyone
looks into. Within a list collisions are counted over a byte of each coordinate,
never too few, and a pair is left to the first list both are posted in by their
whole values (skip).

Only pairs that connect documents leave a list, never all pairs of a group, and
all of them are confirmed on the full shingle sets. First each document meets
the first members of its lists, which connects most groups of copies; lists of
one component are done then. The others are compared block by block and give out
a heaviest spanning forest across components. Where a confirmation failed, the
lists that still hold several components are compared once more, this time on
the full sets inside the block, and give out confirmed links only, no more than
connect what the block holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import BATCH_BYTES, bytes_of, columns_of, mixed, sliced, small_batches, staged, staged_by_bytes, text_bytes
from recordloom.llm.components import components
from recordloom.llm.grouped import block_pairs, by_group, each_group, in_groups, minority_pairs, pairs_of_group, spanning
from recordloom.llm.minhash import COORDINATES, SHINGLE, shingle_sets, signatures

PERCENT = 85
BROADCAST_CLASSES = 1_000_000
# Texts of the pairs that are compared at once.
PAIR_BYTES = BATCH_BYTES // 2
# Shingles of the members of a block whose whole sets meet in one task.
BLOCK_SHINGLES = 1 << 20
# A pair at exactly the wanted similarity agrees in too few coordinates with this chance at most.
MISS = 1e-4


def needed(percent: int) -> int:
    """The most coordinates to ask for that a pair of that similarity falls short of with a chance of ``MISS`` at most."""
    p, short = percent / 100, 0.0
    for k in range(COORDINATES):
        short += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if short > MISS:
            return max(1, k)
    return COORDINATES


ROW_KEY = ("k1", "k2")


def row_key() -> list[Column]:
    """What tells rows apart, in 128 bits: id and text together; a null text is not an empty one."""
    parts = [F.col("doc_id").cast("long"), text_bytes(), F.col("text").isNull()]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")]


def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches, "body"):
        keys, bounds = shingle_sets(*bytes_of(part.column("body")), SHINGLE)
        sums = np.zeros((2, len(keys) + 1), dtype=np.uint64)
        np.cumsum(mixed(keys), out=sums[0, 1:])
        np.cumsum(mixed(keys ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
        h = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
        sig = signatures(keys, bounds).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(np.diff(bounds)), pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)),
                pa.array([s.tobytes() for s in sig], pa.binary()),
            ],
            ["doc_id", "k1", "k2", "n_shingles", "h1", "h2", "sig"],
        )


def posted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each coordinate of each signature; the key holds the coordinate and the value."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            n = part.num_rows
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype="<u4").reshape(n, COORDINATES)
            key = sig.astype(np.int64) | (np.arange(COORDINATES, dtype=np.int64) << 32)
            rep = np.repeat(part.column("rep").to_numpy(zero_copy_only=False), COORDINATES)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(key.ravel())], ["rep", "key"])


def posting_lists(classes: DataFrame, need: int) -> DataFrame:
    """``key``, ``n`` and per member ``rep``, ``posts`` (bits of the coordinates it is posted under),
    ``whole`` (the values of these in order) and ``low`` (a byte of each coordinate): the lists that
    can hold partners, which agree in ``need`` coordinates."""
    posts = classes.select("rep", "sig").mapInArrow(posted, "rep long, key long")
    # Stored, so that the join deals out both its sides itself and can split a long list.
    lengths = staged(posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "lengths")
    shared = posts.join(lengths, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("lists"))
    prefix = COORDINATES - need + 1
    lone = F.lit(COORDINATES) - F.size("lists")
    shared = shared.where(F.size("lists") >= need).select("rep", F.slice("lists", 1, F.greatest(F.lit(0), prefix - lone)).alias("lists"))
    bits = F.aggregate(
        "lists", F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x["key"], 32).cast("int"))),
    )
    low = classes.select("rep", "sig").mapInArrow(lowered, "rep long, low binary")
    value = lambda key: F.shiftright(F.call_function("shiftleft", key, F.lit(32)), 32).cast("int")
    whole = F.transform(F.sort_array(F.transform("lists", lambda x: x["key"])), value)
    shared = shared.where(F.size("lists") > 0).withColumns({"posts": bits, "whole": whole}).join(low, "rep")
    return shared.select("rep", "posts", "whole", "low", F.explode("lists").alias("list")).select(
        F.col("list.key").alias("key"), F.col("list.n").alias("n"), "rep", "posts", "whole", "low", F.lit(need).alias("need")
    )


def lowered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [np.frombuffer(s, dtype="<u4").astype(np.uint8).tobytes() for s in batch.column("sig").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(low, pa.binary())], ["rep", "low"])


def whole_values(rows: pa.Table, posts: np.ndarray) -> np.ndarray:
    """The values of the posted coordinates of each row, 0 for the others."""
    bits = (posts[:, None] >> np.arange(COORDINATES, dtype=np.uint64)) & np.uint64(1) > 0
    values = np.zeros(bits.shape, dtype=np.int32)
    values[bits] = rows.column("whole").combine_chunks().flatten().to_numpy()
    return values


def collisions(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and labels of a group, smallest id first, and the agreeing coordinates of the pairs that are this list's."""
    ids = group.column("rep").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, labels = ids[order], group.column("label").to_numpy()[order]
    posts = group.column("posts").to_numpy().astype(np.int64).view(np.uint64)
    whole, posts = whole_values(group, posts)[order], posts[order]
    need = int(group.column("need")[0].as_py())
    low = np.frombuffer(b"".join(group.column("low").to_pylist()), dtype=np.uint8).reshape(len(ids), COORDINATES)[order]
    here = int(group.column("key")[0].as_py()) >> 32
    matches = np.zeros((len(ids), len(ids)), dtype=np.uint8)
    wanted = pairs_of_group(group, order)
    if (labels == labels[0]).all():
        return ids, labels, matches
    # Across two blocks only the pairs of one with the other are compared.
    left = np.flatnonzero(wanted[0]) if not wanted[0, 0] else np.arange(len(ids))
    right = np.flatnonzero(~wanted[0]) if not wanted[0, 0] else left
    some = np.zeros((len(left), len(right)), dtype=np.uint8)
    earlier = np.zeros((len(left), len(right)), dtype=bool)
    for k in range(COORDINATES):
        some += low[left, k][:, None] == low[right, k][None, :]
        if k < here:
            posted_here = (posts >> np.uint64(k)) & np.uint64(1) > 0
            if posted_here[left].any() and posted_here[right].any():
                same = whole[left, k][:, None] == whole[right, k][None, :]
                earlier |= same & posted_here[left][:, None] & posted_here[right][None, :]
    some[(some < need) | earlier | (ids[left][:, None] == ids[right][None, :])] = 0
    matches[np.ix_(left, right)] = some
    matches[np.ix_(right, left)] = some.T
    return ids, labels, matches


def agreeing(same: np.ndarray, equal: np.ndarray, both: np.ndarray, here: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Agreeing coordinates of pairs; 0 for too few, or where an earlier list than ``here`` has the pair, too.

    ``same`` compares a byte of each coordinate, ``equal`` the whole values of those in ``both``.
    """
    matches = same.sum(axis=-1, dtype=np.uint8)
    bits = np.packbits(equal, axis=-1, bitorder="little").view("<u8")[..., 0]
    before = (np.uint64(1) << here.astype(np.uint64)) - np.uint64(1)
    matches[(matches < need) | ((bits & both & before) != 0)] = 0
    return matches


def _edges(ids: np.ndarray, a, b) -> pa.RecordBatch | None:
    if not len(a):
        return None
    a, b = ids[np.asarray(a, dtype=np.int64)], ids[np.asarray(b, dtype=np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _small(different: bool = True):
    def many(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
        """All pairs of short lists that agree enough."""
        ids, labels = rows.column("rep").to_numpy(), rows.column("label").to_numpy()
        posts = rows.column("posts").to_numpy().astype(np.int64).view(np.uint64)
        low = np.frombuffer(b"".join(rows.column("low").to_pylist()), dtype=np.uint8).reshape(len(ids), COORDINATES)
        whole, need = whole_values(rows, posts), rows.column("need").to_numpy()
        here = rows.column("key").to_numpy() >> 32
        block = rows.column("own").to_numpy()
        first, second = [], []
        for start in range(0, len(left), 20_000):
            x, y = left[start : start + 20_000], right[start : start + 20_000]
            found = agreeing(low[x] == low[y], whole[x] == whole[y], posts[x] & posts[y], here[x], need[x]) > 0
            within = rows.column("i").to_numpy()[x] == rows.column("j").to_numpy()[x]
            found &= (ids[x] != ids[y]) & (within | (block[x] != block[y]))
            if different:
                found &= labels[x] != labels[y]
            first.append(x[found])
            second.append(y[found])
        return _edges(ids, np.concatenate(first), np.concatenate(second)) if first else None

    return many


def forest(group: pa.Table) -> pa.RecordBatch | None:
    ids, labels, matches = collisions(group)
    chosen = spanning(matches, labels)
    return _edges(ids, [x for x, _ in chosen], [y for _, y in chosen])


def shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole shingle set of each text, as bytes of its sorted hashes."""
    for part in sliced(batches, "body"):
        keys, bounds = shingle_sets(*bytes_of(part.column("body")), SHINGLE)
        sets = [keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())], ["rep", "shingles"])


def shared_counts(left: list[bytes], right: list[bytes], chunk: int = 4096) -> np.ndarray:
    """How many shingles each set of one side has in common with each of the other."""
    sides = []
    for sets in (left, right):
        keys = np.frombuffer(b"".join(sets), dtype=np.uint64)
        sides.append((keys, np.repeat(np.arange(len(sets)), [len(s) // 8 for s in sets])))
    common = np.intersect1d(sides[0][0], sides[1][0])
    found = np.zeros((len(left), len(right)), dtype=np.float32)
    places = []
    for keys, row in sides:
        at = np.searchsorted(common, keys)
        at[at == len(common)] = 0
        keep = common[at] == keys if len(common) else np.zeros(len(keys), dtype=bool)
        at, row = at[keep], row[keep]
        order = np.argsort(at, kind="stable")
        places.append((at[order], row[order]))
    for start in range(0, len(common), chunk):
        parts = []
        for (at, row), n in zip(places, found.shape):
            lo, hi = np.searchsorted(at, (start, start + chunk))
            part = np.zeros((n, chunk), dtype=np.float32)
            part[row[lo:hi], at[lo:hi] - start] = 1
            parts.append(part)
        found += parts[0] @ parts[1].T
    return found.astype(np.int64)


def candidates(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a group's minority, those of its whole list, and which of their pairs agree enough, join
    two components and belong to this list."""
    ids, labels = group.column("rep").to_numpy(), group.column("label").to_numpy()
    posts = group.column("posts").to_numpy().astype(np.int64).view(np.uint64)
    low = np.frombuffer(b"".join(group.column("low").to_pylist()), dtype=np.uint8).reshape(len(ids), COORDINATES)
    whole, few = whole_values(group, posts), group.column("minor").to_numpy(zero_copy_only=False)
    left, right = np.flatnonzero(few), np.flatnonzero(~few)
    here, need = int(group.column("key")[0].as_py()) >> 32, int(group.column("need")[0].as_py())
    same = np.zeros((len(left), len(right)), dtype=np.uint8)
    earlier = np.zeros(same.shape, dtype=bool)
    for k in range(COORDINATES):
        same += low[left, k][:, None] == low[right, k][None, :]
        if k < here:
            posted_here = (posts >> np.uint64(k)) & np.uint64(1) > 0
            equal = whole[left, k][:, None] == whole[right, k][None, :]
            earlier |= equal & posted_here[left][:, None] & posted_here[right][None, :]
    return left, right, (same >= need) & ~earlier & (labels[left][:, None] != labels[right][None, :])


def involved(group: pa.Table) -> pa.RecordBatch | None:
    """The rows of a group that are in any of its pairs. A pair belongs to one list, so few rows stay of most."""
    left, right, wanted = candidates(group)
    rows = np.concatenate([left[wanted.any(axis=1)], right[wanted.any(axis=0)]])
    return group.take(pa.array(rows)).combine_chunks().to_batches()[0] if len(rows) else None


def verified(percent: int):
    """Links between members of different components, confirmed on whole sets, as many as connect them at most."""

    def links(group: pa.Table) -> pa.RecordBatch | None:
        left, right, wanted = candidates(group)
        x, y = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not len(x):
            return None
        ids, labels = group.column("rep").to_numpy(), group.column("label").to_numpy()
        sets = group.column("shingles").to_pylist()
        a, b = [sets[i] for i in left[x]], [sets[i] for i in right[y]]
        shared = shared_counts(a, b)
        total = np.array([len(s) // 8 for s in a])[:, None] + np.array([len(s) // 8 for s in b])[None, :] - shared
        p, q = np.nonzero(wanted[np.ix_(x, y)] & (100 * shared >= percent * total))
        p, q = left[x[p]], right[y[q]]
        number = np.unique(labels, return_inverse=True)[1]
        _, first = np.unique(np.minimum(number[p], number[q]) * len(ids) + np.maximum(number[p], number[q]), return_index=True)
        part = list(range(len(ids)))

        def of(i: int) -> int:
            while part[i] != i:
                part[i] = part[part[i]]
                i = part[i]
            return i

        chosen = []
        for i in first:
            u, v = of(number[p[i]]), of(number[q[i]])
            if u != v:
                part[u] = v
                chosen.append(i)
        return _edges(ids, p[chosen], q[chosen]) if chosen else None

    return links


def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of lists that agree enough with the first of their list, and in how many coordinates."""
    for batch in batches:
        n = batch.num_rows
        own, first = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(n, COORDINATES) for c in ("low", "first_low")
        )
        agree = (own == first).sum(axis=1)
        keep = pa.array((agree >= batch.column("need").to_numpy()) & (batch.column("rep").to_numpy() != batch.column("first").to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep").filter(keep), batch.column("first").filter(keep), pa.array(agree).filter(keep)], ["rep", "first", "agree"]
        )


def first_pairs(lists: DataFrame) -> DataFrame:
    """``a``, ``b``: each document with that first member of its lists it agrees with most."""
    firsts = lists.groupBy("key").agg(F.min(F.struct("rep", "low")).alias("f"))
    firsts = staged(firsts.select("key", F.col("f.rep").alias("first"), F.col("f.low").alias("first_low")), "firsts")
    pairs = lists.select("key", "rep", "low", "need").join(firsts, "key").select("rep", "low", "first", "first_low", "need")
    pairs = pairs.mapInArrow(met, "rep long, first long, agree long")
    best = pairs.groupBy("rep").agg(F.max(F.struct("agree", (-F.col("first")).alias("less"))).alias("best"))
    return best.select((-F.col("best.less")).alias("a"), F.col("rep").alias("b"))


def labelled(lists: DataFrame, linked: DataFrame) -> DataFrame:
    """The lists with the component of each member; lists of a single component are left out."""
    marked = lists.join(linked.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep"))
    marked = staged(marked.drop("component"), "marked")
    mixed_lists = marked.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    return marked.join(staged(mixed_lists.select("key"), "mixed"), "key")


def overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared and all shingles of pairs of texts; both texts of a pair count towards the bytes of a lot."""
    for part in sliced(batches, "body_a", "body_b", limit=PAIR_BYTES):
        sets = []
        for name in ("body_a", "body_b"):
            keys, bounds = shingle_sets(*bytes_of(part.column(name)), SHINGLE)
            sets.append((keys, bounds, np.repeat(np.arange(part.num_rows), np.diff(bounds))))
        keys = np.concatenate([sets[0][0], sets[1][0]])
        row = np.concatenate([sets[0][2], sets[1][2]])
        order = np.lexsort((keys, row))
        keys, row = keys[order], row[order]
        twice = (keys[1:] == keys[:-1]) & (row[1:] == row[:-1])
        shared = np.bincount(row[1:][twice], minlength=part.num_rows)
        union = np.diff(sets[0][1]) + np.diff(sets[1][1]) - shared
        yield pa.RecordBatch.from_arrays(
            [part.column("a"), part.column("b"), pa.array(shared.astype(np.int64)), pa.array(union.astype(np.int64))],
            ["a", "b", "shared", "total"],
        )


def bodies_of(reps: DataFrame, classes: DataFrame, texts: DataFrame, repeated: bool) -> DataFrame:
    """``rep`` and ``body``, the text of one row of each class."""
    wanted = staged(classes.join(reps.distinct(), "rep").select("rep", F.col("row.k1").alias("k1"), F.col("row.k2").alias("k2")), "wanted")
    # Three numbers a class: sent to the texts while there are not too many, so that only texts that are wanted move.
    right = F.broadcast(wanted) if wanted.count() <= BROADCAST_CLASSES else wanted
    found = texts.drop("doc_id").join(right, [*ROW_KEY])
    # Repeated rows have one key, and one of them is enough.
    return (found.dropDuplicates([*ROW_KEY]) if repeated else found).select("rep", "body")


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, repeated: bool) -> DataFrame:
    """``a``, ``b`` and ``link``: whether the full shingle sets are similar enough."""
    left, right = (bodies_of(pairs.select(F.col(c).alias("rep")), classes, texts, repeated).toDF(c, f"body_{c}") for c in ("a", "b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "body_a", "body_b")
    got = both.mapInArrow(overlaps, "a long, b long, shared long, total long")
    return got.select("a", "b", (100 * F.col("shared") >= percent * F.col("total")).alias("link"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``k1``, ``k2`` and ``group`` for every row (``doc_id``, ``text``).

    Documents that share ``percent`` of their shingles or more are linked.
    ``component_id`` is the smallest id a document reaches by links; ``group`` is
    a number of its component, ``k1`` and ``k2`` are the row's key.

    Words are compared without case of A to Z. A null text or one without words
    has no shingles, no group and is linked with nothing; a text shorter than a
    shingle is one shingle. Texts of any length are read whole. Repeated rows
    share their component; rows that share an id but not the text are documents
    of their own. Rows without an id are linked like others; a component without
    any id has none (null). Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    texts = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), text_bytes().alias("body"))
    kind = "doc_id long, k1 long, k2 long, n_shingles long, h1 long, h2 long, sig binary"
    rows = staged(texts.mapInArrow(sketched, kind), "sketches")
    found = rows.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(*ROW_KEY)).alias("row"), F.min("sig").alias("sig"),
        F.min("n_shingles").alias("n_shingles"),
    )
    # Numbered once, when they are stored; the numbers stand for the classes from here on.
    classes = staged(found.withColumn("rep", F.monotonically_increasing_id()), "classes")
    lists = staged(posting_lists(classes, needed(percent)), "lists")
    repeated = not rows.where("n_shingles > 0").groupBy(*ROW_KEY).count().where("count > 1").isEmpty()
    pairs = staged(first_pairs(lists), "pairs")
    tested = staged_by_bytes(confirmed(pairs, classes, texts, percent, repeated), "tested")
    linked = staged(components(tested.where("link")), "linked")
    pairs = block_pairs(labelled(lists, linked), "n", "rep").mapInArrow(by_group(forest, _small(True)), "a long, b long")
    pairs = staged(pairs.distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    tested = tested.union(staged_by_bytes(confirmed(pairs, classes, texts, percent, repeated), "tested"))
    links = tested.where("link").select("a", "b")
    linked = staged(components(links), "linked")
    failed = tested.where("NOT link")
    if not failed.isEmpty():
        # Parts that only a failed pair holds together may be linked by other pairs.
        suspects = components(tested).withColumnRenamed("component", "whole")
        whole = suspects.union(suspects.select("whole", "whole").distinct()).toDF("rep", "whole")
        torn = failed.select(F.col("a").alias("rep")).distinct().join(whole, "rep").select("whole").distinct()
        reps = staged(whole.join(torn, "whole").join(classes.select("rep", F.col("n_shingles").alias("weight")), "rep").select("rep", "weight"), "suspects")
        open_lists = staged(labelled(lists.join(reps, "rep"), linked), "open")
        dealt = minority_pairs(open_lists.drop("n"), "rep", BLOCK_SHINGLES)
        few = staged(dealt.mapInArrow(each_group(involved), dealt.schema), "few")
        sets = bodies_of(few.select("rep"), classes, texts, repeated).mapInArrow(shingled, "rep long, shingles binary")
        more = in_groups(few.join(sets, "rep")).mapInArrow(each_group(verified(percent)), "a long, b long")
        more = staged_by_bytes(more, "more")
        linked = staged(components(links.union(more)), "linked")
    groups = classes.join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", "doc_id", F.coalesce("component", "rep").alias("group")
    )
    groups = staged(groups, "groups")
    least = staged(groups.groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    named = groups.drop("doc_id").join(least, "group")
    full = rows.drop("sig").where("n_shingles > 0").join(staged(named, "named"), ["h1", "h2"])
    empty = rows.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "group": F.lit(None).cast("long")})
    columns = ["doc_id", "n_shingles", "component_id", *ROW_KEY, "group"]
    every = full.select(*columns).union(empty.select(*columns))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id (then key), once.

    Of a component without ids one row stays; rows without words all stay, but
    for repeated ones. All columns are kept, whatever these are called.
    """
    found = near_duplicates(docs, percent)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *ROW_KEY)
    best = found.where("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("row")).select("row.k1", "row.k2")
    keys = staged(best.union(found.where("group IS NULL").select(*ROW_KEY)).distinct(), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key())
    once = rows.join(keys, [*ROW_KEY], "left_semi").dropDuplicates([*ROW_KEY])
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
