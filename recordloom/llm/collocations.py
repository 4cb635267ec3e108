"""Phrase collocations of each language, by top-order marginalisation.

Every word occurrence opens one window: the word and the words that lead it
within its piece of text, in five columns padded with empty strings. Only these
longest windows are counted; a ROLLUP over the five columns sums the counts of
all shorter prefixes, so the number of a phrase's occurrences is the total of
the windows that begin with it and the total of a language is the number of its
words. No n-gram of another order is ever exploded.

A phrase can occur ``LEAST`` times only if all its words, pairs and triples of
neighbouring words do. Windows therefore end before the first of these that is
too rare for certain, which leaves few different windows. What is too rare is
known from counts over hashed buckets, which are never too small: a bucket holds
its words or runs of words and perhaps others'. A bitmap of the buckets of each
order is all that is broadcast. Their number follows the size of the corpus, up
to ``MAX_BUCKETS`` (16 MB a bitmap). They decide how far windows reach, never a
count: when a corpus outgrows them, at some hundred GB, windows get longer, the
rows that are counted more, and the counts stay what they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import (
    BYTE_VALUES, LOWER, SPACE, bytes_of, mixed, prefix_sums, sliced, small_batches, span_hashes, staged, text_bytes, word_spans,
)

ORDER = 5
LEAST = 100
# A candidate gives way to a longer one with so many per cent of its occurrences.
COVERED = 100
TOP = 2000
UNKNOWN = "und"
# Orders whose rare members end a window.
FILTERED = 3
MIN_BUCKETS, MAX_BUCKETS = 1 << 22, 1 << 27
BYTES_PER_BUCKET = 48
CHUNK = 1 << 16
# Bucket numbers that a task gathers before it counts them.
NUMBERS = 1 << 22
# Different windows that a task gathers before it hands them on, and the parts they are dealt to.
GATHERED = 1 << 20
SLOTS = 512
SALTS = 32

BREAK = np.zeros(256, dtype=bool)
BREAK[np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8)] = True
LEADS = [f"w{i + 1}" for i in range(ORDER)]


class Words:
    """The words of texts laid end to end: bytes, hash, number of the language, whether the next word is in the same piece."""

    def __init__(self, part: pa.RecordBatch):
        data, offsets = bytes_of(part.column("body"))
        self.data = LOWER[data]
        self.starts, self.ends, bounds = word_spans(self.data, offsets, SPACE | BREAK)
        self.hashes = span_hashes(prefix_sums(BYTE_VALUES[self.data]), self.starts, self.ends)
        breaks = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(BREAK[self.data], out=breaks[1:])
        n = len(self.starts)
        self.joined = np.zeros(n, dtype=bool)
        if n:
            self.joined[:-1] = breaks[self.starts[1:]] == breaks[self.ends[:-1]]
            self.joined[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
        langs = part.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(bounds)).astype(np.int64)
        seeds = np.array([lang_seed(x) for x in self.langs], dtype=np.uint64)
        self.seed = seeds[self.lang] if n else np.zeros(0, dtype=np.uint64)

    def text(self, at: int) -> bytes:
        return self.data[self.starts[at] : self.ends[at]].tobytes()

    def reaching(self, filters: list[np.ndarray], order: int) -> Iterator[np.ndarray]:
        """For each length up to ``order``, which words begin a run of so many words without a rare part.

        Runs longer than the filters tell apart have their last two parts looked at.
        """
        alive, keys = np.ones(len(self.hashes), dtype=bool), mixed(self.hashes ^ self.seed)
        for length in range(1, order + 1):
            if length > 1:
                keys = mixed(keys[:-1] * np.uint64(3) + self.hashes[length - 1 :])
                alive = alive[:-1] & alive[1:] & self.joined[: len(alive) - 1]
            if length <= len(filters):
                bits = filters[length - 1]
                bucket = keys[alive] & np.uint64(8 * len(bits) - 1)
                alive[alive] = bits[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8) & 1 > 0
            self.keys = keys
            yield alive


def lang_seed(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode(), dtype=np.uint8)
    return span_hashes(prefix_sums(BYTE_VALUES[data]), np.array([0]), np.array([len(data)]))[0]


def read(filters: list[Broadcast]) -> list[np.ndarray]:
    return [np.frombuffer(f.value, dtype=np.uint8) for f in filters]


def bucketed(least: int, buckets: int, filters: list[Broadcast]):
    """Counts of the buckets of all runs one word longer than ``filters`` knows, as far as their parts may be
    frequent: per chunk of buckets the places that occur and how often, ``least`` at most."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gathered = read(filters), []

        def counted() -> Iterator[pa.RecordBatch]:
            at, many = np.unique(np.concatenate(gathered), return_counts=True)
            gathered.clear()
            chunk, first = np.unique(at // CHUNK, return_index=True)
            ends = np.append(first[1:], len(at))
            place, many = (at % CHUNK).astype("<u2"), np.minimum(many, least).astype("<u4")
            for lo in range(0, len(chunk), 64):
                ranges = list(zip(first[lo : lo + 64], ends[lo : lo + 64]))
                columns = [[values[a:b].tobytes() for a, b in ranges] for values in (place, many)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[lo : lo + 64].astype(np.int64)), *[pa.array(c, pa.binary()) for c in columns]], ["chunk", "places", "counts"]
                )

        for part in sliced(batches, "body"):
            words = Words(part)
            for alive in words.reaching(known, len(filters) + 1):
                pass
            gathered.append((words.keys[alive] & np.uint64(buckets - 1)).astype(np.uint32))
            if sum(map(len, gathered)) > NUMBERS:
                yield from counted()
        if gathered:
            yield from counted()

    return rows


def summed(least: int):
    """Per chunk, a bit for each bucket that was counted ``least`` times or more."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "places", "counts"))):
                total = totals.setdefault(chunk, np.zeros(CHUNK, dtype=np.int32))
                at = np.frombuffer(places, dtype="<u2")
                total[at] = np.minimum(total[at] + np.frombuffer(counts, dtype="<u4").astype(np.int32), least)
        bits = [np.packbits(t >= least, bitorder="little").tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(bits, pa.binary())], ["chunk", "bits"])

    return rows


def may_be_frequent(rows: DataFrame, least: int) -> list[Broadcast]:
    """For runs of one to ``FILTERED`` words, a bitmap of the buckets that were counted ``least`` times."""
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << (size // BYTES_PER_BUCKET).bit_length()))
    filters: list[Broadcast] = []
    for _ in range(FILTERED):
        parts = rows.mapInArrow(bucketed(least, buckets, list(filters)), "chunk long, places binary, counts binary").repartition("chunk")
        bits = bytearray(buckets // 8)
        for chunk, some in parts.mapInArrow(summed(least), "chunk long, bits binary").collect():
            bits[chunk * (CHUNK // 8) : (chunk + 1) * (CHUNK // 8)] = some
        filters.append(rows.sparkSession.sparkContext.broadcast(bytes(bits)))
    return filters


def windows_of(filters: list[Broadcast]):
    """The different windows with their numbers (language, five columns padded with empty strings, count), as lists for
    each of ``SLOTS`` parts, which equal windows of all tasks share."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = read(filters)
        gathered: list[tuple[np.ndarray, ...]] = []
        spelt: dict[int, bytes] = {}
        langs: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            keys, lang, window, n = (np.concatenate([g[i] for g in gathered]) for i in range(4))
            _, first, same = np.unique(keys, return_index=True, return_inverse=True)
            total = np.bincount(same, n).astype(np.int64)
            hashes = np.fromiter(spelt, dtype=np.uint64, count=len(spelt))
            by_hash = np.argsort(hashes)
            texts = list(spelt.values())
            names = pa.array([b"", *[texts[i] for i in by_hash]], pa.binary()).cast(pa.string())
            place = np.where(window[first] == 0, 0, np.searchsorted(hashes[by_hash], window[first]) + 1)
            slot = (keys[first] % np.uint64(SLOTS)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            slots, cuts = np.unique(slot[order], return_index=True)
            columns = [pa.array(list(langs)).cast(pa.string()).take(pa.array(lang[first][order]))]
            columns += [names.take(pa.array(place[order, k])) for k in range(ORDER)]
            cuts = pa.array(np.append(cuts, len(order)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, c) for c in (*columns, pa.array(total[order]))]
            gathered.clear()
            spelt.clear()
            return pa.RecordBatch.from_arrays([pa.array(slots), *lists], ["slot", "lang", *LEADS, "n"])

        for part in sliced(batches, "body"):
            got = Words(part)
            n = len(got.hashes)
            if not n:
                continue
            window = np.zeros((n, ORDER), dtype=np.uint64)
            fine = np.zeros(n, dtype=bool)
            for k, alive in enumerate(got.reaching(known, ORDER)):
                window[: len(alive), k][alive] = got.hashes[k:][alive]
                fine[: len(alive)] |= alive
            numbers = np.array([langs.setdefault(x, len(langs)) for x in got.langs], dtype=np.int64)
            lang = numbers[got.lang]
            keys = np.array([lang_seed(x) for x in got.langs], dtype=np.uint64)[got.lang]
            for k in range(ORDER):
                keys = mixed(keys * np.uint64(3) + window[:, k])
            keys, first, many = np.unique(keys, return_index=True, return_counts=True)
            gathered.append((keys, lang[first], window[first], many))
            names, at = np.unique(got.hashes[fine], return_index=True)
            at = np.flatnonzero(fine)[at]
            for name, i in zip(names.tolist(), at.tolist()):
                if name not in spelt:
                    spelt[name] = got.text(i)
            if sum(len(g[0]) for g in gathered) > GATHERED:
                yield flushed()
        if gathered:
            yield flushed()

    return rows


def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of all lists with their numbers, equal ones added up as far as they are held at one time."""
    names = ["lang", *LEADS]
    held: list[pa.Table] = []

    def total() -> pa.Table:
        sums = pa.concat_tables(held).group_by(names, use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select([*names, "n"])

    for batch in batches:
        held.append(pa.table({c: batch.column(c).flatten() for c in (*names, "n")}))
        if sum(t.num_rows for t in held) > GATHERED:
            held[:] = [total()]
            if held[0].num_rows > GATHERED // 2:
                yield from held.pop().to_batches()
    if held:
        yield from total().to_batches()


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``f`` of every phrase of up to five words that occurs ``least``
    times or more; the row without words holds the number of all words of the language."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_bytes().alias("body"))
    names = ("lang", *LEADS)
    lists = "slot long, " + ", ".join(f"{c} array<string>" for c in names) + ", n array<long>"
    windows = rows.mapInArrow(windows_of(may_be_frequent(rows, least)), lists).repartition("slot")
    windows = windows.mapInArrow(together, ", ".join(f"{c} string" for c in names) + ", n long")
    windows = windows.groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))
    sums = windows.rollup("lang", *LEADS).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # Columns that are summed over are the last ones, and bits of the grouping id.
    length = F.lit(ORDER) - F.length(F.regexp_replace(F.conv(F.col("g").cast("string"), 10, 2), "0", ""))
    found = sums.where("lang IS NOT NULL").withColumn("m", length).withColumn("all", F.array(*LEADS))
    found = found.where((F.col("m") == 0) | ((F.col("f") >= least) & (F.element_at("all", F.greatest(F.col("m"), F.lit(1))) != "")))
    found = found.withColumn("words", F.slice("all", 1, F.col("m")))
    return staged(found.select("lang", "words", F.array_join("words", " ").alias("phrase"), "f"), "phrases")


def parts(words: str, lengths: list[tuple[int, int]]) -> Column:
    """The phrases that begin at a place and have a length, as far as they lie inside ``words``."""
    made = [
        F.when((F.size(words) >= start + n) & (F.size(words) > n), F.array_join(F.slice(words, start + 1, n), " ")) for start, n in lengths
    ]
    return F.array_compact(F.array(*made))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's first ``top`` phrases.

    Texts are read without case of A to Z and whole. A phrase is a run of two to
    five words of one piece; pieces end at ``.,;:!?`` and line ends, words at
    blanks and tabs. It is a candidate from ``least`` occurrences on, scored by
    its weakest cut (floor of 1000 a n / (l r), exact), and gives way to a longer
    candidate around it that occurs ``covered`` per cent as often.

    A null language counts as ``und``; null and empty texts have no words;
    repeated rows and copies are counted like any others, whatever their ids;
    an empty table has no phrases. Columns but ``lang`` and ``text`` are ignored.
    """
    counts = phrase_counts(docs, least)
    found = counts.where(F.size("words") > 1).withColumnRenamed("f", "a")
    known = counts.where(F.size("words") > 0).select("lang", "phrase", "f")
    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("tail"),
    )
    cut = cut.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cut = cut.join(counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n")), "lang")
    # Integers of up to 38 digits: exact far beyond 64 bits.
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("above", (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    cut = cut.withColumn("below", wide("l") * wide("r")).withColumn("score", F.expr("above div below"))
    weakest = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = [(start, n) for n in range(2, ORDER) for start in range(ORDER - n + 1)]
    longer = found.select("lang", F.col("a").alias("around"), F.explode(parts("words", inner)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where("around IS NULL OR 100 * around < {} * a".format(int(covered)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: each of its parts is cut to the wanted number first.
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("_r") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# The same by SQL.
PHRASES_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, w[i:i + m - 1] AS words, count(*)::HUGEINT AS f
  FROM placed, (SELECT unnest(range(1, {ORDER + 1})) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}),
found AS (SELECT lang, words, f AS a FROM grams WHERE len(words) > 1),
cuts AS (
  SELECT c.lang, c.words, c.a, k, h.f AS l, t.f AS r, n, (1000 * c.a * n) // (h.f * t.f) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM found) c JOIN totals USING (lang)
  JOIN grams h ON h.lang = c.lang AND h.words = c.words[1:k] JOIN grams t ON t.lang = c.lang AND t.words = c.words[k + 1:]),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, words[s:s + m - 1] AS words, max(a) AS around
  FROM found, (SELECT unnest(range(1, {ORDER})) AS s), (SELECT unnest(range(2, {ORDER})) AS m)
  WHERE m < len(words) AND s + m - 1 <= len(words) GROUP BY ALL),
kept AS (
  SELECT w.*, array_to_string(w.words, ' ') AS phrase FROM weakest w LEFT JOIN inner_parts p ON p.lang = w.lang AND p.words = w.words
  WHERE p.around IS NULL OR 100 * p.around < {COVERED} * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""
