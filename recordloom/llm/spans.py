"""Substring dedup by sliding sentence spans.

Every run of several consecutive sentences is hashed: from each sentence
forward, and up to each sentence backward, the shortest run of at least
``SENTENCES`` sentences and ``WORDS`` words. Runs are joined globally on their
hash; sentences covered by a run that stood earlier (in a smaller document id,
or further up in the same text) are removed, so one copy of each passage stays.

Of any ``WINDOW`` words in a row one ends a sentence: where no mark does, it is
the word of the smallest hash. A passage of p words is thus cut alike wherever
it stands, but for its first ``WINDOW`` and last ``WINDOW - 1`` words at most,
and a run spans up to ``WORDS + WINDOW - 1`` words. So each passage of at least
``WORDS + 3 * WINDOW - 2`` words (49) holds a run. Lines end sentences, too, but
move no other cut, and runs between the other cuts do not depend on them.

Keys of runs are counted first, combined before the shuffle; only runs that
stand twice are stored. The joins are ones that adaptive execution can split, so
a passage shared by any number of documents is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import (
    BYTE_VALUES, LOWER, bytes_of, prefix_sums, sliced, small_batches, span_hashes, staged, text_bytes, word_spans,
)

SENTENCES = 3
WORDS = 24
# The longest piece: longer sentences are cut behind the word of the smallest hash in a window of so many words.
WINDOW = 9
MARKS = np.zeros(256, dtype=bool)
MARKS[np.frombuffer(b".!?", dtype=np.uint8)] = True


class Sentences:
    """The sentences of texts laid end to end: first and last word, byte where each begins, row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, bounds = word_spans(data, offsets)
        words = span_hashes(prefix_sums(BYTE_VALUES[LOWER[data]]), starts, ends)
        self.word_sums = prefix_sums(words)
        n = len(starts)
        stop, lines = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        if n:
            breaks = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(data == 10, out=breaks[1:])
            stop |= MARKS[data[ends - 1]]
            stop[smallest(np.where(stop, np.uint64(0), words), bounds)] = True
            stop[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
            lines[:-1] = breaks[starts[1:]] > breaks[ends[:-1]]
        # Words before each cut that does not depend on lines.
        self.fixed = np.flatnonzero(stop) + 1
        self.lines = np.flatnonzero(lines & ~stop) + 1
        stop |= lines
        self.last = np.flatnonzero(stop) + 1
        self.first = np.concatenate([[0], self.last[:-1]]).astype(np.int64) if n else self.last
        self.row = np.searchsorted(bounds, self.first, side="right") - 1
        # Sentences before each row, and where the bytes of each begin: white space belongs to the sentence before.
        self.bounds = np.searchsorted(self.first, bounds)
        self.begin = starts[self.first] if n else self.first
        self.begin = np.where(np.isin(np.arange(len(self.first)), self.bounds[:-1]), offsets[self.row] if n else 0, self.begin)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last sentence (exclusive) of all runs, each once."""
        count = len(self.first)
        if not count:
            return self.first, self.first
        at = np.arange(count)
        # What lies between two cuts that do not depend on lines, and which sentences these are.
        to = np.searchsorted(self.last, self.fixed) + 1
        since = np.concatenate([[0], to[:-1]])
        first, last = shortest(self.first[since], self.fixed, self.bounds[:-1][self.row[since]], self.bounds[1:][self.row[since]], since, to)
        pairs = [first * (count + 1) + last]
        if len(self.lines):
            # Runs that begin or end at a line, over all sentences.
            first, last = shortest(self.first, self.last, self.bounds[:-1][self.row], self.bounds[1:][self.row], at, at + 1)
            lined = np.isin(self.first[first], self.lines) | np.isin(self.last[last - 1], self.lines)
            pairs.append(first[lined] * (count + 1) + last[lined])
        return np.divmod(np.unique(np.concatenate(pairs)), count + 1)


def smallest(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The place of the smallest value (the last of equal ones) in each window of ``WINDOW`` words of a row."""
    windows = max(0, len(values) - WINDOW + 1)
    place = np.arange(windows)
    best = values[:windows].copy()
    for k in range(1, WINDOW):
        here = values[k : k + windows]
        less = here <= best
        best[less] = here[less]
        place[less] = np.flatnonzero(less) + k
    inside = np.repeat(bounds[1:], np.diff(bounds))[:windows] >= np.arange(windows) + WINDOW
    return place[inside]


def shortest(begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray):
    """The shortest runs forward from and backward to each piece: their first and last sentence (exclusive).

    A piece has the words from ``begin`` to ``end``, the sentences from ``first``
    to ``last`` and stands in a text of sentences from ``low`` to ``high``.
    """
    at, n = np.arange(len(begin)), len(begin)
    until = np.maximum(at + SENTENCES, np.searchsorted(end, begin + WORDS) + 1) - 1
    forward = until < n
    forward[forward] = last[until[forward]] <= high[forward]
    since = np.minimum(at + 1 - SENTENCES, np.searchsorted(begin, end - WORDS, side="right") - 1)
    backward = since >= 0
    backward[backward] = first[since[backward]] >= low[backward]
    return (
        np.concatenate([first[forward], first[since[backward]]]), np.concatenate([last[until[forward]], last[backward]]),
    )


def emitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches, "body"):
        cut = Sentences(*bytes_of(part.column("body")))
        first, last = cut.runs()
        if not len(first):
            continue
        row = cut.row[first]
        keys = span_hashes(cut.word_sums, cut.first[first], cut.last[last - 1])
        pick = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc").take(pick), part.column("row").take(pick), pa.array(keys.view(np.int64)),
                pa.array((first - cut.bounds[row]).astype(np.int32)), pa.array((last - first).astype(np.int32)),
            ],
            ["doc", "row", "key", "begin", "size"],
        )


def cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences that the runs in ``_spans`` cover."""
    for part in sliced(batches, "body"):
        data, offsets = bytes_of(part.column("body"))
        cut = Sentences(data, offsets)
        spans = part.column("_spans")
        lengths = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = spans.flatten()
        begin = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
        size = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = begin + np.repeat(cut.bounds[:-1], lengths)
        edge = np.zeros(len(cut.first) + 1, dtype=np.int64)
        np.add.at(edge, begin, 1)
        np.subtract.at(edge, begin + size, 1)
        gone = np.cumsum(edge[:-1]) > 0
        words = (cut.last - cut.first) * gone
        n_rows = part.num_rows
        removed = np.bincount(cut.row[gone], minlength=n_rows)
        removed_words = np.bincount(cut.row, words, minlength=n_rows).astype(np.int64)
        texts: list[bytes | None] = []
        ends = np.append(cut.begin[1:], len(data)) if len(cut.first) else cut.begin
        for i in range(n_rows):
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            if removed[i]:
                here = np.arange(cut.bounds[i], cut.bounds[i + 1])
                body = b"".join(
                    data[cut.begin[j] : min(ends[j], offsets[i + 1])].tobytes() for j in here[~gone[here]]
                )
            texts.append(body)
        text = pa.array([t if known else None for t, known in zip(texts, part.column("_known").to_pylist())], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [part.column("_rest"), text.cast(pa.string()), pa.array(np.diff(cut.bounds)), pa.array(removed), pa.array(removed_words)],
            ["_rest", "text", "n_sentences", "n_removed", "removed_words"],
        )


def doc_key() -> Column:
    """The id; documents without one come after all others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def row_key() -> Column:
    """With the id, what tells rows apart."""
    return F.xxhash64(F.col("text"), F.col("text").isNull())


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc`` and ``row``, and the ``spans`` (first sentence, number) of the row that an earlier place has, too."""
    rows = docs.select(doc_key().alias("doc"), row_key().alias("row"), text_bytes().alias("body"))
    runs = rows.mapInArrow(emitted, "doc long, row long, key long, begin int, size int")
    # Stored, so that the joins deal out both their sides themselves and can split a hot passage.
    twice = staged(runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "twice")
    again = staged(runs.join(twice, "key"), "again")
    places = staged(again.groupBy("key").agg(F.min(F.struct("doc", "row", "begin")).alias("first")), "places")
    later = again.join(places, "key").where(F.struct("doc", "row", "begin") != F.col("first"))
    return later.groupBy("doc", "row").agg(F.collect_set(F.struct("begin", "size")).alias("spans"))


def without_repeated_spans(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with repeated passages taken out of ``text``.

    Adds ``n_sentences``, ``n_removed`` and ``removed_words`` (columns of these
    names are replaced, all others kept). A sentence ends with ``.``, ``!`` or ``?`` before white
    space, with a line, or inside nine words without such an end; words are
    compared without case, white space is not compared. Texts with fewer than
    three sentences or 24 words have no runs
    and stay; a null text stays null, an empty one empty; a text that is all
    repeated becomes empty, its row stays. Rows that agree in id and text are
    one document and end up alike; rows without an id come after all others.
    """
    small_batches(docs.sparkSession)
    made = ("text", "n_sentences", "n_removed", "removed_words")
    rest = [c for c in docs.columns if c not in made]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), F.col("text").isNotNull().alias("_known"),
        text_bytes().alias("body"), doc_key().alias("_doc"), row_key().alias("_row"),
    )
    wide = packed.join(repeated_spans(docs).toDF("_doc", "_row", "_spans"), ["_doc", "_row"], "left")
    wide = wide.select("_rest", "_known", "body", "_spans")
    kind = wide.schema["_rest"].dataType.simpleString()
    got = wide.mapInArrow(cleaned, f"_rest {kind}, text string, n_sentences long, n_removed long, removed_words long")
    order = [F.col("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in made[1:]]
    return got.select(*order, *made[1:])
