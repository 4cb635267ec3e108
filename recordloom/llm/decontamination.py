"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words is one window. The hashes of all windows are broadcast, every text is
scanned where it is read, and a hash that is found is verified on the words
themselves before it counts.

The set is broadcast only if its windows and bytes, which Spark counts first,
stay within ``BROADCAST_WINDOWS`` and ``BROADCAST_BYTES``. Larger benchmarks are
joined: hashes of the texts' windows meet the benchmark's hashes in a join that
adaptive execution can split, and the windows that are left are joined once more
on their words. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import (
    BYTE_VALUES, LOWER, bytes_of, prefix_sums, sliced, small_batches, span_hashes, staged, text_bytes, word_spans,
)

WINDOW = 10
BROADCAST_WINDOWS = 500_000
BROADCAST_BYTES = 48 << 20
MADE = ("n_words", "n_hit", "items")

# Words are runs of digits, letters and all characters beyond ASCII.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x41:0x5B] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False


class Words:
    """The lower-case words of texts laid end to end and the hashes of their windows."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = bytes_of(column)
        self.data = LOWER[self.raw]
        self.starts, self.ends, self.bounds = word_spans(self.data, self.offsets, BETWEEN)
        self.counts = np.diff(self.bounds)
        self.sums = prefix_sums(span_hashes(prefix_sums(BYTE_VALUES[self.data]), self.starts, self.ends))

    def windows(self, width: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first word and hash of all windows of a width; ``exact``: of texts of just so many words."""
        here = np.where(self.counts == width if exact else self.counts >= width, self.counts - width + 1, 0)
        row = np.repeat(np.arange(len(here)), here)
        at = np.arange(len(row)) - np.repeat(np.cumsum(here) - here, here) + self.bounds[:-1][row]
        return row, at, span_hashes(self.sums, at, at + width)

    def text(self, at: int, width: int) -> bytes:
        """The words of a window, joined by blanks."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[at : at + width], self.ends[at : at + width]))


def benchmark_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches, "body"):
        words = Words(part.column("body"))
        for width in np.unique(np.minimum(words.counts, WINDOW)):
            if width:
                row, at, keys = words.windows(int(width), exact=width < WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("item").take(pa.array(row)), pa.array(np.full(len(row), width, np.int32)), pa.array(keys.view(np.int64)),
                        pa.array([words.text(i, int(width)) for i in at], pa.binary()),
                    ],
                    ["item", "width", "key", "words"],
                )


class WindowSet:
    """The windows of the benchmark: sorted hashes per width; by hash the windows' words and their items."""

    def __init__(self, rows: list):
        self.found: dict[int, dict[bytes, list[str]]] = {}
        by_width: dict[int, list[int]] = {}
        for key, width, words, items in rows:
            self.found.setdefault(key, {})[bytes(words)] = list(items)
            by_width.setdefault(width, []).append(key)
        self.keys = {w: np.unique(np.array(k, dtype=np.int64)) for w, k in by_width.items()}

    def hits(self, words: Words) -> Iterator[tuple[int, int, int, list[str]]]:
        """Row, first word, width and items of each verified window."""
        for width, keys in self.keys.items():
            row, at, hashes = words.windows(width)
            hashes = hashes.view(np.int64)
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            for i in np.flatnonzero(keys[place] == hashes):
                items = self.found[int(hashes[i])].get(words.text(at[i], width))
                if items is not None:
                    yield int(row[i]), int(at[i]), width, items


def without_hits(words: Words, row: int, hit: np.ndarray) -> bytes:
    """A text without its runs of hit words; what stands between words stays, but for that inside a run."""
    lo, hi = words.bounds[row], words.bounds[row + 1]
    inside = np.concatenate([[False], hit[lo:hi], [False]])
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + lo
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + lo
    edges = np.concatenate([[words.offsets[row]], np.column_stack([words.starts[begin], words.ends[end - 1]]).ravel(), [words.offsets[row + 1]]])
    return b"".join(words.raw[a:b].tobytes() for a, b in edges.reshape(-1, 2))


def marked(part: pa.RecordBatch, words: Words, hit: np.ndarray, items: list[list[str]], cut: bool) -> pa.RecordBatch:
    """The rows of a batch with what was found in them; ``cut`` takes hit words out of the texts."""
    before = np.zeros(len(hit) + 1, dtype=np.int64)
    np.cumsum(hit, out=before[1:])
    n_hit = before[words.bounds[1:]] - before[words.bounds[:-1]]
    body = part.column("body")
    if cut and n_hit.any():
        texts = body.to_pylist()
        for row in np.flatnonzero(n_hit):
            texts[row] = without_hits(words, row, hit)
        body = pa.array(texts, pa.binary())
    text = pa.array([t if known else None for t, known in zip(body.to_pylist(), part.column("_known").to_pylist())], pa.binary())
    columns = [part.column("_rest"), text.cast(pa.string()), pa.array(words.counts), pa.array(n_hit), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["_rest", "text", *MADE])


def covered(n: int, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Which of ``n`` words the windows cover."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + width, 1)
    return np.cumsum(edge[:-1]) > 0


def scanned(windows, cut: bool):
    """Texts against the broadcast set."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = windows.value
        for part in sliced(batches, "body"):
            words = Words(part.column("body"))
            items: list[set[str]] = [set() for _ in range(part.num_rows)]
            at, width = [], []
            for row, first, n, named in known.hits(words):
                items[row].update(named)
                at.append(first)
                width.append(n)
            hit = covered(len(words.starts), np.array(at, dtype=np.int64), np.array(width, dtype=np.int64))
            yield marked(part, words, hit, [sorted(i) for i in items], cut)

    return rows


def keyed(widths: list[int]):
    """Hashes of all windows of these widths, for the join."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "body"):
            words = Words(part.column("body"))
            for width in widths:
                row, at, keys = words.windows(width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_key").take(pa.array(row)), pa.array((at - words.bounds[:-1][row]).astype(np.int64)),
                        pa.array(np.full(len(row), width, np.int32)), pa.array(keys.view(np.int64)),
                    ],
                    ["_key", "at", "width", "key"],
                )

    return rows


def spelt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the windows in ``_spans``."""
    for part in sliced(batches, "body"):
        words = Words(part.column("body"))
        key, at, width, text = [], [], [], []
        for row, (name, spans) in enumerate(zip(part.column("_key").to_pylist(), part.column("_spans").to_pylist())):
            for span in spans:
                key.append(name)
                at.append(span["at"])
                width.append(span["width"])
                text.append(words.text(words.bounds[row] + span["at"], span["width"]))
        columns = [pa.array(key, pa.binary()), pa.array(at, pa.int64()), pa.array(width, pa.int32()), pa.array(text, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["_key", "at", "width", "words"])


def applied(cut: bool):
    """Texts with the verified windows in ``_spans``."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "body"):
            words = Words(part.column("body"))
            spans = part.column("_spans").to_pylist()
            at = np.array([words.bounds[row] + s["at"] for row, some in enumerate(spans) for s in some or ()], dtype=np.int64)
            width = np.array([s["width"] for some in spans for s in some or ()], dtype=np.int64)
            items = [sorted(i or ()) for i in part.column("_items").to_pylist()]
            yield marked(part, words, covered(len(words.starts), at, width), items, cut)

    return rows


def joined_hits(texts: DataFrame, windows: DataFrame, widths: list[int]) -> DataFrame:
    """``_key``, the verified windows and the items of texts that hold any. A key is a digest of the whole text."""
    hashes = texts.mapInArrow(keyed(widths), "_key binary, at long, width int, key long")
    # Stored, so that the joins deal out both their sides themselves and can split a hot window.
    known = staged(windows.select("key", "width").distinct(), "keys")
    spans = hashes.join(known, ["key", "width"]).groupBy("_key").agg(F.collect_set(F.struct("at", "width")).alias("_spans"))
    found = staged(texts.join(staged(spans, "spans"), "_key").mapInArrow(spelt, "_key binary, at long, width int, words binary"), "found")
    real = staged(found.join(staged(windows.select("words").distinct(), "words"), "words", "left_semi"), "real")
    spans = real.groupBy("_key").agg(F.collect_set(F.struct("at", "width")).alias("_spans"))
    items = real.select("_key", "words").distinct().join(windows.select("words", "item"), "words")
    return spans.join(items.groupBy("_key").agg(F.collect_set("item").alias("_items")), "_key", "left")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, remove: str = "spans",
    broadcast_windows: int = BROADCAST_WINDOWS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside a benchmark window) and ``items`` (the sorted ids, as strings).

    ``remove``: "spans" takes the runs of hit words out of ``text``, "documents"
    drops rows with a hit, "nothing" only reports. Words are runs of digits,
    letters and characters beyond ASCII, compared without case of A to Z.

    Null and empty texts have no words and stay as they are. Texts of any length
    are read whole, repeated rows are handled each. Items of fewer than ten words
    are found as a whole, items without words never. Items that share an id are
    one item; an item without an id still hits words but has no name in
    ``items``. With an empty benchmark nothing is hit. Columns of ``docs`` called
    ``n_words``, ``n_hit`` and ``items`` are replaced, all others kept.
    """
    if remove not in ("spans", "documents", "nothing"):
        raise ValueError(f"remove is 'spans', 'documents' or 'nothing', not {remove!r}")
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), text_bytes().alias("body"))
    windows = staged(items.mapInArrow(benchmark_windows, "item string, width int, key long, words binary"), "windows")
    # Named items only: repeated ones are one, and none is needed to hit.
    sets = windows.groupBy("key", "width", "words").agg(F.collect_set("item").alias("items"))
    size = windows.agg(F.count("*"), F.sum(F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()
    cut = remove == "spans"
    rest = [c for c in docs.columns if c not in (*MADE, "text")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), F.col("text").isNotNull().alias("_known"), text_bytes().alias("body"),
    )
    kind = f"_rest {rows.schema['_rest'].dataType.simpleString()}, text string, n_words long, n_hit long, items array<string>"
    if size[0] <= broadcast_windows and (size[1] or 0) <= broadcast_bytes:
        known = docs.sparkSession.sparkContext.broadcast(WindowSet(sets.collect()))
        got = rows.mapInArrow(scanned(known, cut), kind)
    else:
        widths = sorted(r[0] for r in windows.select("width").distinct().collect())
        rows = rows.withColumn("_key", F.unhex(F.sha2("body", 256)))
        hits = joined_hits(rows.select("_key", "body").dropDuplicates(["_key"]), windows, widths)
        got = rows.join(staged(hits, "hits"), "_key", "left").mapInArrow(applied(cut), kind)
    if remove == "documents":
        got = got.where("n_hit = 0")
    kept = [F.col("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in MADE]
    return got.select(*kept, *MADE)


# The same by SQL.
HITS_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
doc AS (SELECT row, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS g FROM starts),
places AS (SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
hits AS (SELECT row, i, p.k, item_id FROM (SELECT row, i, k, w[i:i + k - 1] AS g FROM places) p JOIN windows USING (g)),
words AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT row, i, k FROM hits)) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (row) LEFT JOIN named USING (row)
"""
