"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; the model of a category sees the
probabilities of those before it. While the chain is trained these come from
models that have not seen the row (out-of-fold), afterwards from the models
fitted on all rows of the sample.

A word gives features for itself and for its beginnings of three to six
characters, so inflected forms of a known stem count. Which features matter is
decided by a chi-square test of their document counts, which Spark gathers;
models are fitted on a bounded sample (``SAMPLE`` labelled documents, chosen by
a hash of their ids, and ``FEATURES`` features), each by a task of its own. Only
names of features and weights reach the driver, and every document is scored
where it is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from recordloom.llm.common import sliced, small_batches, staged, text_bytes

CATEGORIES = ("quality", "toxic")
SAMPLE = 20_000
FEATURES = 4096
MIN_DOCS = 4
# Features below this chi-square tell a category apart no better than chance does among a million of them.
MIN_SCORE = 25.0
FOLDS = 5
THRESHOLD = 0.3
STEPS = 200
RATE = 0.1
# Penalty of the squared weights, per row of the sample.
PENALTY = 1e-5
REMEMBERED = 100_000
EDGE = b".,;:!?\"'()[]{}<>*%&$#|"


def word_features(word: bytes) -> tuple[bytes, ...]:
    """A lower-case word and its beginnings; empty if nothing but marks is left of it."""
    word = word.strip(EDGE)
    if not word:
        return ()
    text = word.decode("utf-8", "replace")
    return (b"w" + word, *(b"p" + text[:n].encode() for n in (3, 4, 5, 6) if len(text) > n))


def features_of(body: bytes) -> set[bytes]:
    """The distinct features of a text."""
    found: set[bytes] = set()
    for word in set(body.lower().split()):
        found.update(word_features(word))
    return found


class Chosen:
    """The chosen features of texts by number; what a word gives is remembered, up to a bound."""

    def __init__(self, names: list[bytes]):
        self.number = {name: i for i, name in enumerate(names)}
        self.words: dict[bytes, tuple[int, ...]] = {}

    def of(self, body: bytes) -> list[int]:
        found: set[int] = set()
        for word in set(body.lower().split()):
            known = self.words.get(word)
            if known is None:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                known = tuple(self.number[f] for f in word_features(word) if f in self.number)
                self.words[word] = known
            if known:
                found.update(known)
        return sorted(found)


def labelled_sample(docs: DataFrame, labels: DataFrame, categories, size: int) -> DataFrame:
    """At most ``size`` labelled documents, a row for each id: ``doc_id``, ``body`` and ``y``, the categories as an array.

    Labels of ids that ``docs`` lacks take no place in the sample. Of an id with
    several texts the least one is learnt from.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in categories])
    known = known.dropna().groupBy("doc_id").agg(F.array(*[F.max(c) for c in categories]).alias("y"))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    # The sample is bounded: at most ``size`` ids and flags.
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("body").alias("body"), F.first("y").alias("y"))


def counted(categories: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        hits: list[Counter] = [Counter() for _ in range(categories)]
        docs, positive = 0, [0] * categories

        def flushed() -> pa.RecordBatch:
            names = [b"", *seen]
            columns = [pa.array(names, pa.binary()), pa.array([docs, *[seen[f] for f in names[1:]]], pa.int64())]
            columns.append(pa.array([positive, *[[h[f] for h in hits] for f in names[1:]]], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, ["feature", "n", "hits"])

        for part in sliced(batches, "body"):
            for body, y in zip(part.column("body").to_pylist(), part.column("y").to_pylist()):
                found = features_of(body)
                seen.update(found)
                docs += 1
                for c, flag in enumerate(y):
                    if flag:
                        positive[c] += 1
                        hits[c].update(found)
            if len(seen) > REMEMBERED:
                yield flushed()
                seen, hits, docs, positive = Counter(), [Counter() for _ in range(categories)], 0, [0] * categories
        if docs:
            yield flushed()

    return rows


def chosen_features(sample: DataFrame, categories: int, size: int = FEATURES) -> tuple[list[bytes], np.ndarray, int]:
    """The features that tell the categories apart best, by chi-square over document counts,
    for each category which of them are its own, and the number of documents."""
    counts = sample.select("body", "y").mapInArrow(counted(categories), "feature binary, n long, hits array<long>")
    hits = [F.sum(F.col("hits")[c]).alias(f"h{c}") for c in range(categories)]
    counts = staged(counts.groupBy("feature").agg(F.sum("n").alias("n"), *hits), "features")
    total = counts.where(F.length("feature") == 0).first()
    if total is None:
        return [], np.zeros((categories, 0), dtype=bool), 0
    docs = float(total["n"])
    best = []
    for c in range(categories):
        positive = float(total[f"h{c}"])
        expected = F.col("n") * F.lit(positive / docs)
        gap = F.col(f"h{c}") - expected
        score = gap * gap / F.greatest(F.lit(1e-9), F.col("n") * F.lit(positive / docs * (1 - positive / docs)))
        top = counts.where((F.length("feature") > 0) & (F.col("n") >= MIN_DOCS) & (score >= MIN_SCORE)).orderBy(F.desc(score), "feature")
        best.append([bytes(r[0]) for r in top.select("feature").limit(size // categories).collect()])
    names = sorted(set().union(*best))
    own = [set(b) for b in best]
    return names, np.array([[n in b for n in names] for b in own], dtype=bool).reshape(categories, len(names)), int(docs)


def indexed(names: list[bytes]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(names)
        for part in sliced(batches, "body"):
            found = [chosen.of(b) for b in part.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("y"), pa.array(found, pa.list_(pa.int16()))], ["doc_id", "y", "found"]
            )

    return rows


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Presence:
    """Which features are present in which rows: blocks of row and feature numbers as short as they
    can be, so that the sample takes four bytes an entry and work on it no more room than a block."""

    SIZE = 1 << 19
    ROWS = 2000

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.blocks = [(rows[i : i + self.SIZE], ids[i : i + self.SIZE]) for i in range(0, len(ids), self.SIZE)]

    @classmethod
    def of(cls, found: pa.Array | pa.ChunkedArray, own: np.ndarray, order: np.ndarray | None = None) -> Presence:
        """The features of ``own`` in lists of feature numbers, a list a row, in the given order of the rows."""
        kind, made = np.min_scalar_type(max(1, len(found))), cls(np.zeros(0), np.zeros(0))
        for start in range(0, len(found), cls.ROWS):
            part = found.slice(start, cls.ROWS) if order is None else found.take(pa.array(order[start : start + cls.ROWS]))
            lists = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(start, start + len(lists)).astype(kind), lists.value_lengths().to_numpy(zero_copy_only=False))
            if len(ids):
                keep = own[ids]
                made.blocks += cls(rows[keep], ids[keep]).blocks
        return made

    def by_row(self, weights: np.ndarray, size: int) -> np.ndarray:
        return sum((np.bincount(rows, weights[ids], minlength=size) for rows, ids in self.blocks), np.zeros(size))

    def by_feature(self, values: np.ndarray, size: int) -> np.ndarray:
        return sum((np.bincount(ids, values[rows], minlength=size) for rows, ids in self.blocks), np.zeros(size))


class Linear:
    """Logistic regression over present features and some dense inputs, fitted by Adam on all rows at once."""

    def __init__(self, features: int, dense: int):
        self.weights = np.zeros(features + dense + 1)
        self.features = features

    def scores(self, present: Presence, dense: np.ndarray) -> np.ndarray:
        linear = present.by_row(self.weights, len(dense))
        return linear + dense @ self.weights[self.features : -1] + self.weights[-1]

    def fit(self, present: Presence, dense: np.ndarray, y: np.ndarray) -> Linear:
        mean, square = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for step in range(1, STEPS + 1):
            error = (logistic(self.scores(present, dense)) - y) / max(1, len(y))
            slope = np.concatenate([present.by_feature(error, self.features), error @ dense, [error.sum()]])
            slope[:-1] += PENALTY * self.weights[:-1]
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope * slope
            self.weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return self


def clipped(p: np.ndarray) -> np.ndarray:
    """Probabilities as inputs of later models, on the log-odds scale."""
    p = np.clip(p, 0.001, 0.999)
    return np.log(p / (1 - p))


def dense_of(table: pa.Table | pa.RecordBatch, category: int) -> np.ndarray:
    """What the models before have made of each row."""
    return np.array(table.column("dense").to_pylist(), dtype=float).reshape(table.num_rows, category)


def fitted_once(category: int, own: np.ndarray):
    """The model of one job: all rows of the sample but those of a fold."""

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        y = np.array(table.column("y").to_pylist(), dtype=float)[order, category]
        present = Presence.of(table.column("found"), own, order)
        model = Linear(len(own), category).fit(present, dense_of(table, category)[order], y)
        return pa.table({"job": table.column("job").slice(0, 1).cast(pa.int32()), "weights": pa.array([model.weights], pa.list_(pa.float64()))})

    return fit


def unseen(category: int, own: np.ndarray, models: dict[int, np.ndarray]):
    """Rows with what the model that has not seen their fold makes of them, as a further dense input."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present, dense = Presence.of(batch.column("found"), own), dense_of(batch, category)
            fold, p = batch.column("fold").to_numpy(zero_copy_only=False), np.zeros(batch.num_rows)
            for k in np.unique(fold):
                model = Linear(len(own), category)
                model.weights = models.get(int(k), model.weights)
                p[fold == k] = clipped(logistic(model.scores(present, dense)))[fold == k]
            made = pa.array(list(np.column_stack([dense, p])), pa.list_(pa.float64()))
            columns = [made if c == "dense" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rows


def fit_chain(sample: DataFrame, uses: np.ndarray, folds: int = FOLDS) -> list[np.ndarray]:
    """The weights of the chain's models: features, earlier categories, intercept.

    ``sample`` has ``doc_id``, ``y`` and ``found``, the numbers of the features
    in a document. Every model of a category, the one of all rows and those of
    all but a fold, is fitted by a task of its own; a task holds the sample,
    which is bounded, and only weights come back.
    """
    categories, features = uses.shape
    kind = "doc_id long, y array<int>, found array<short>, fold int, dense array<double>"
    rows = sample.select(
        "doc_id", "y", "found", F.pmod("doc_id", F.lit(folds)).cast("int").alias("fold"), F.array().cast("array<double>").alias("dense")
    )
    chain = []
    for c in range(categories):
        last = c + 1 == categories
        jobs = rows.withColumn("job", F.explode(F.array(*[F.lit(k) for k in range(-1, -1 if last else folds)], *[F.lit(-1)] * last)))
        got = jobs.where("job <> fold").groupBy("job").applyInArrow(fitted_once(c, uses[c]), "job int, weights array<double>").collect()
        models = {r.job: np.array(r.weights) for r in got}
        chain.append(models.get(-1, np.zeros(features + c + 1)))
        if not last:
            rows = staged(rows.mapInArrow(unseen(c, uses[c], models), kind), "chain")
    return chain


def scored(names: list[bytes], chain: list[np.ndarray]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, features = Chosen(names), len(names)
        for part in sliced(batches, "body"):
            found = [chosen.of(b) for b in part.column("body").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            present = Presence(at, np.array([i for f in found for i in f], dtype=np.int64))
            dense, out = np.zeros((len(found), 0)), []
            for weights in chain:
                model = Linear(features, dense.shape[1])
                model.weights = weights
                p = logistic(model.scores(present, dense))
                out.append(p)
                dense = np.column_stack([dense, clipped(p)])
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(list(np.column_stack(out)), pa.list_(pa.float64()))],
                [*part.schema.names[:-1], "p"],
            )

    return rows


def fitted(docs: DataFrame, labels: DataFrame, categories, sample_size: int) -> tuple[list[bytes], list[np.ndarray], int]:
    """The chosen features, the chain's weights and the number of documents learnt from."""
    small_batches(docs.sparkSession)
    sample = staged(labelled_sample(docs, labels, categories, sample_size), "labelled")
    names, uses, learnt = chosen_features(sample, len(categories))
    found = staged(sample.mapInArrow(indexed(names), "doc_id long, y array<int>, found array<short>"), "found")
    return names, fit_chain(found, uses), learnt


def predicted(docs: DataFrame, names: list[bytes], chain: list[np.ndarray]) -> DataFrame:
    """``row``, all columns of a row as a struct, and ``p``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_bytes().alias("body"))
    return rows.mapInArrow(scored(names, chain), rows.select("row").schema.add("p", ArrayType(DoubleType())))


def toxicity(
    docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample_size: int = SAMPLE, train_docs: DataFrame | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``p``, the probability of each category in turn.

    Labels of an id that occurs twice are joined by "any"; ids without a label
    or with a null one are not learnt from. The models come from ``train_docs``
    (``docs`` unless given). A null or empty text has no features and gets the
    chain's base rates; without any labelled document all probabilities are 0.5;
    repeated rows are scored each. A column ``p`` of ``docs`` is replaced.
    """
    names, chain, _ = fitted(docs if train_docs is None else train_docs, labels, categories, sample_size)
    return unpacked(predicted(docs, names, chain), docs, "p")


def unpacked(rows: DataFrame, docs: DataFrame, *made: str) -> DataFrame:
    """The columns of ``docs`` out of ``row``, but for those called like ``made``, and these."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in made], *made)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``p`` and ``toxic``, whether the last category is at least
    ``threshold`` likely. Nothing is toxic if there was no labelled document to learn from."""
    names, chain, learnt = fitted(docs, labels, CATEGORIES, SAMPLE)
    return predicted(docs, names, chain).withColumn("toxic", F.element_at("p", -1) >= threshold if learnt else F.lit(False))


def flagged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``toxicity`` with ``toxic`` of ``judged``. Columns of ``docs`` called ``p`` or ``toxic`` are replaced, all others kept."""
    return unpacked(judged(docs, labels, threshold), docs, "p", "toxic")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their own columns, whatever these are called."""
    return unpacked(judged(docs, labels, threshold).where("NOT toxic"), docs)
