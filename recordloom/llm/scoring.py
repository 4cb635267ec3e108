"""Language-model scores of documents by logistic context mixing.

Tokens are lower-case words and one end per text. The most frequent words are
anchors; the state before a token is the pair of the last two anchors. A token
is coded as: where the token before it stood earlier in the text, whether what
followed there comes again, from predictors that adapt to how well such matches
held in this text; if not, whether the corpus has the word; if so, its 8-bit code (anchors
have codes of their own, other words share one with words of like beginning),
bit by bit, from predictors over four contexts of the state, then the word by
its share of the code; if not, its code and the bytes of its spelling, bit by
bit, from predictors over the last one to six bytes. All bits but one (whether the corpus
has the word, at the share of words seen once) go through the same kind of mixer
(``context_mixing``).

A second score, ``context_score``, asks first whether the word is one of those that
followed the last two words anywhere in the corpus, then for the match in the text,
then for those that followed the last word, and goes on as above only if none holds;
a word of these is coded by its share of what followed. A document that is learnt
from leaves its own token out.

Counts cover the whole training part and grow with the corpus: hashes of the words of
small chunks of documents, and of each word with the one and the two before it, are
added up in ranges, and the totals come back to the chunks, so only what is distinct
in a chunk travels. New words are joined by themselves. The tables of the bit predictors have a fixed number
of slots, as hashed contexts do, and are summed over all documents. The spelling
mixer learns from every word of the training part: words are dealt by their hash
to parts of about ``PART_WORDS``, each part follows its words one after the other,
and what the parts have learnt is averaged by the bits each has seen.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import (
    BASE, BYTE_VALUES, LOWER, bytes_of, columns_of, mixed, offsets_of, prefix_sums, sliced, small_batches, span_hashes, staged, text_bytes, word_spans,
)
from recordloom.llm.context_mixing import ORDERS, SLOT_BITS, CodeModel, FollowModel, MatchModel, SpellingModel, spelling_counts

ANCHORS = 63
NO_ANCHOR = 63
CHUNK_BYTES = 12 << 20
# A task packs so many words at a time.
GATHER_WORDS = 1 << 19
PART_WORDS = 100_000
LEARN_AT_ONCE = 512
COUNT_AT_ONCE = 8000
END = b""
# Numbers of words before a token that make its contexts. Words by themselves travel as 56 bits of their hashes, with a
# context as so many bits more than those of the number of tokens, by which one in 8000 new ones looks like another.
CONTEXTS = (1, 2)
WORD_BITS = 56
CHECK_BITS = 13
NO_WORD = np.uint64(1)
SLOT_BLOCK = 1 << 16
# All that a task writes is one file.
ONE_FILE = {"spark.sql.files.maxRecordsPerFile": "0"}
# For passes that need each file they read whole and in its order: a task a file.
WHOLE_FILES = {f"spark.sql.files.{name}": str(1 << 44) for name in ("maxPartitionBytes", "openCostInBytes")}
# Shuffles go when the table or result they were made for is there.
BRIEF_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
DOCS_AT_ONCE = 400
HELD_OUT = (7, 2)

# Codes 64 to 255 of the first two bytes of a word.
CODES = (64 + mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) % np.uint64(192)).astype(np.int64)


def code_of(word: bytes, anchors: dict[bytes, int]) -> int:
    known = anchors.get(word)
    if known is not None:
        return known
    return int(CODES[(word[0] if word else 0) * 256 + (word[1] if len(word) > 1 else 0)])


class Tokens:
    """The tokens of texts laid end to end: bytes, hash of each, and where each text's begin; a text ends with ``END``."""

    def __init__(self, column: pa.Array):
        data, offsets = bytes_of(column)
        self.data = LOWER[data]
        starts, ends, bounds = word_spans(self.data, offsets)
        hashes = span_hashes(prefix_sums(BYTE_VALUES[self.data]), starts, ends)
        counts = np.diff(bounds)
        self.begins = bounds[:-1] + np.arange(len(counts))
        self.lengths = counts + 1
        n = int(self.lengths.sum())
        word = np.ones(n, dtype=bool)
        word[self.begins + counts] = False
        self.starts, self.ends, self.hashes = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.uint64)
        self.starts[word], self.ends[word], self.hashes[word] = starts, ends, hashes


def binaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes between some places."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


def packed(ids: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers byte by byte, the low bytes of all first."""
    return ids.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def unpacked(rows: list[bytes], kind: str = "<i4") -> np.ndarray:
    """The numbers of several rows, one after the other."""
    parts = [np.frombuffer(r, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T for r in rows]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).ravel() if parts else np.zeros(0, kind)


def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: a row with the hashes of its words and their codes as if no word were an anchor, one for each document
    with the numbers of its tokens, and one for each distinct word."""
    task, count = TaskContext.get().partitionId(), 0
    names = ["chunk", "doc_id", "held_out", "n_bytes", "ids", "codes", "word", "number", "train", "hashes"]
    # A row of hashes has the codes and the number of the words, too; of the other words only those not learnt from here need one.
    held_parts: list[tuple[pa.RecordBatch, Tokens]] = []

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal count
        chunk = (task << 24) + count
        parts = [t for _, t in held_parts]
        shift = np.cumsum([0, *[len(t.data) for t in parts]])
        data = np.concatenate([t.data for t in parts])
        starts = np.concatenate([t.starts + np.int32(s) for t, s in zip(parts, shift)])
        ends = np.concatenate([t.ends + np.int32(s) for t, s in zip(parts, shift)])
        distinct, ids, many = told_apart(np.concatenate([t.hashes for t in parts]))
        first = np.empty(len(distinct), dtype=np.int64)
        first[ids] = np.arange(len(ids))
        # Frequent words get small numbers, which take less room; words about as frequent go by their hashes, whose steps do.
        order = np.argsort(-np.log2(many).astype(np.int64), kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ids, first = rank[ids], first[order]
        starts, ends = starts[first].astype(np.int64), ends[first].astype(np.int64)
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        head = np.where(ends > starts, padded[starts], 0).astype(np.int64) * 256 + np.where(ends > starts + 1, padded[starts + 1], 0)
        codes = CODES[head].astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk]), *(pa.nulls(1, kind) for kind in (pa.int64(), pa.bool_(), pa.int64(), pa.binary())), pa.array([codes.tobytes()], pa.binary()),
                pa.nulls(1, pa.binary()), pa.array([len(order)], pa.int32()), pa.nulls(1, pa.int64()),
                pa.array([squeezed(np.diff(distinct[order] >> np.uint64(64 - WORD_BITS), prepend=np.uint64(0)))], pa.binary()),
            ],
            names,
        )
        train, done = np.zeros(len(first), dtype=np.int64), 0
        for batch, t in held_parts:
            own = ids[done : done + len(t.hashes)]
            done += len(t.hashes)
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            train += np.bincount(own[~np.repeat(held, t.lengths)], minlength=len(train))
            cuts = np.append(t.begins, len(own))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(offsets_of(batch.column("body")))),
                    pa.array([packed(own[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()), pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                ],
                names,
            )
        words = binaries(data, starts, ends)
        for start in range(0, len(words), 20_000):
            some = words.slice(start, 20_000)
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), some, pa.array(np.arange(start, start + n, dtype=np.int32), mask=train[start : start + n] > 0),
                    pa.array(train[start : start + n]), pa.nulls(n, pa.binary()),
                ],
                names,
            )
        held_parts.clear()
        count += 1

    for part in sliced(batches, "body"):
        held_parts.append((part, Tokens(part.column("body"))))
        if sum(len(t.data) for _, t in held_parts) >= CHUNK_BYTES:
            yield from flushed()
    if held_parts:
        yield from flushed()


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned keys in order and where each stood, equal ones as they came."""
    shift = max(1, len(keys) - 1).bit_length()
    if int(keys.max(initial=0)).bit_length() + shift > 64:
        places = np.argsort(keys, kind="stable")
        return keys[places], places
    # Numbers alone are sorted much faster than their places.
    both = np.sort((keys.astype(np.uint64) << np.uint64(shift)) | np.arange(len(keys), dtype=np.uint64))
    return both >> np.uint64(shift), (both & np.uint64((1 << shift) - 1)).view(np.int64)


def told_apart(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the number of each of all, and how often they come."""
    shift = np.uint64(max(1, len(hashes) - 1).bit_length())
    high, places = ranked(hashes >> shift)
    own = hashes[places]
    new = np.diff(own, prepend=~own[:1]) != 0
    if (new[1:] & (high[1:] == high[:-1])).any():
        # Other words with the same high bits may stand between those of a word.
        return np.unique(hashes, return_inverse=True, return_counts=True)
    first = np.flatnonzero(new)
    ids = np.empty(len(hashes), dtype=np.int64)
    ids[places] = np.cumsum(new) - 1
    return own[first], ids, np.diff(first, append=len(hashes))


def states(codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last anchor and the one before it ahead of each token; texts begin without any."""
    anchor = codes < ANCHORS
    places = np.flatnonzero(anchor)
    before = np.cumsum(anchor) - anchor
    first = np.repeat(np.searchsorted(places, begins), lengths)
    out = []
    for back in (1, 2):
        at = before - back
        inside = at >= first
        out.append(np.where(inside, codes[places[np.where(inside, at, 0)]] if len(places) else NO_ANCHOR, NO_ANCHOR))
    return out[0], out[1]


def matches(ids: np.ndarray, codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the token before stood earlier in the same text, whether what followed it there comes
    again, and the cell of ``MatchModel``, for each token."""
    n = len(ids)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(n)
    key = doc.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    key, order = ranked(key)
    earlier = np.full(n + 1, -1)
    same = key[1:] == key[:-1]
    earlier[order[1:][same]] = order[:-1][same]
    start = np.repeat(begins, lengths)
    source = np.where(at > start, earlier[at - 1], -1)
    has = source >= 0
    hit = has & (ids[np.where(has, source + 1, 0)] == ids)
    before = np.where(at > start, codes[at - 1], 0)
    return has, hit, cells_of(has, hit, before, 256, begins, lengths)


# Whole logarithms of small numbers; more than its last counts as this.
WIDE_LOG2 = np.log2(np.maximum(1, np.arange(1 << 15))).astype(np.int64)
LOG2 = np.minimum(7, np.log2(np.maximum(1, np.arange(129))).astype(np.int64))


def cells_of(has: np.ndarray, hit: np.ndarray, beside: np.ndarray, size: int, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Cells of a predictor that adapts within a text: hits in a row before each token, a number below
    ``size``, the share of hits among the tokens before it that had a prediction, and how many had."""
    at, start = np.arange(len(has)), np.repeat(begins, lengths)
    missed = np.maximum.accumulate(np.where(hit, -1, at))
    row = np.where(at > start, np.minimum(at - 1 - missed[at - 1], at - start), 0)
    tries = np.cumsum(has) - has
    held = np.cumsum(hit) - hit
    tries, held = tries - np.repeat(tries[begins], lengths), held - np.repeat(held[begins], lengths)
    rate = np.minimum(7, 8 * held // np.maximum(1, tries))
    often = LOG2[np.minimum(len(LOG2) - 1, 1 + tries)]
    return ((np.minimum(row, 15) * size + beside) * 8 + rate) * 8 + often


def key_bits(train: int) -> tuple[int, ...]:
    """Bits of the keys of words and of what follows contexts, given the tokens that are learnt from."""
    return (WORD_BITS, *[min(63, train.bit_length() + CHECK_BITS)] * len(CONTEXTS))


def context_keys(words: np.ndarray, begins: np.ndarray, lengths: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hashes of each token together with the ``order`` tokens before it; texts begin after empty places."""
    if not order:
        return words
    at = np.arange(len(words)) - np.repeat(begins, lengths)
    h = np.full(len(words), order, dtype=np.uint64)
    for back in range(order, 0, -1):
        before = np.full(len(words), NO_WORD)
        before[back:] = words[:-back]
        h = (h + np.where(at >= back, before, NO_WORD)) * BASE
    return mixed((h + words) * BASE) >> np.uint64(64 - bits)


def by_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Documents in the order in which ``encoded`` wrote them, with the number of their chunk and the hashes and codes of its words."""
    chunk, hashes, codes = None, None, None
    for batch in batches:
        chunks, first = batch.column("chunk").to_numpy(zero_copy_only=False), batch.column("hashes").is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(first)
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if lo < hi and first[lo]:
                chunk, hashes = int(chunks[lo]), hashes_of(batch.column("hashes")[lo].as_py(), batch.column("number")[lo].as_py())
                codes = np.frombuffer(batch.column("codes")[lo].as_py(), dtype=np.uint8).astype(np.int64)
                lo += 1
            if lo < hi:
                if (chunks[lo:hi] != chunk).any():
                    raise ValueError("documents of a chunk apart from its words")
                yield chunk, hashes, codes, batch.slice(lo, hi - lo)


def followers(parts: int, key_bits: tuple[int, ...]):
    """The words of a chunk, and what follows one and two words: sorted hashes and how often each is learnt from, by ranges of the hashes."""
    bounds = [np.array([(p << bits) // parts for p in range(parts)], dtype=np.uint64) for bits in key_bits]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(chunk: int, words: np.ndarray, docs: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw = [x for batch in docs for x in batch.column("ids").to_pylist()]
            held = np.concatenate([batch.column("held_out").to_numpy(zero_copy_only=False) for batch in docs])
            lengths = np.array([len(x) // 4 for x in raw], dtype=np.int64)
            ids = unpacked(raw)
            del raw
            hashes, held = words[ids], np.repeat(held, lengths)
            begins = np.cumsum(lengths) - lengths
            for order in (0, *CONTEXTS):
                if order:
                    keys = np.sort((context_keys(hashes, begins, lengths, order, key_bits[order]) << np.uint64(1)) | held)
                    counts, keys = 1 - (keys & np.uint64(1)).astype(np.int64), keys >> np.uint64(1)
                else:
                    # Words go by their numbers first.
                    places = np.argsort(words)
                    keys, counts = words[places], np.bincount(ids[~held], minlength=len(words))[places]
                first = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
                keys, counts = keys[first], np.add.reduceat(counts, first)
                lowest = bounds[order]
                cuts = [*np.searchsorted(keys, lowest), len(keys)]
                spans = [(p + order * parts, slice(lo, hi)) for p, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if lo < hi]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(spans), pa.int64()), pa.array([p for p, _ in spans], pa.int32()), pa.array([s.stop - s.start for _, s in spans], pa.int32()),
                        pa.array([squeezed(np.diff(keys[s], prepend=lowest[p % parts])) for p, s in spans], pa.binary()), pa.array([squeezed(counts[s]) for _, s in spans], pa.binary()),
                    ],
                    ["of", "part", "n", "keys", "totals"],
                )

        at, words, docs = None, None, []
        for chunk, hashes, _, some in by_chunk(batches):
            if chunk != at and docs:
                yield from flushed(at, words, docs)
                docs = []
            at, words = chunk, hashes
            docs.append(some)
        if docs:
            yield from flushed(at, words, docs)

    return rows


def hashes_of(data: bytes, n: int) -> np.ndarray:
    """Hashes from the steps between them."""
    return np.cumsum(loosened(data, n).view(np.uint64), dtype=np.uint64)


def totalled(rows: pa.Table) -> pa.Table:
    """How often all that chunks have in a range of the hashes is learnt from in the whole corpus."""
    sizes = rows.column("n").to_numpy()
    keys = np.concatenate([hashes_of(x.as_py(), n) for x, n in zip(rows.column("keys"), sizes)])
    counts = np.concatenate([loosened(x.as_py(), n) for x, n in zip(rows.column("totals"), sizes)])
    keys, order = ranked(keys)
    new = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
    sums = np.empty(len(keys), dtype=np.int64)
    sums[order] = np.repeat(np.add.reduceat(counts[order], new), np.diff(new, append=len(keys)))
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({
        "of": rows.column("of"), "part": rows.column("part"), "n": rows.column("n"), "totals": pa.array([squeezed(x) for x in np.split(sums, cuts)], pa.binary()),
    })


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte as in ``packed``, without the high bytes that none uses."""
    wide = numbers.astype("<u8", copy=False)
    used = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :used].T)
    return bytes([used]) + pa.compress(planes, codec="zstd", asbytes=True)


def loosened(data: bytes, n: int) -> np.ndarray:
    used, n = data[0], int(n)
    raw = pa.decompress(pa.py_buffer(data).slice(1), decompressed_size=used * n, codec="zstd", asbytes=True)
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :used] = np.frombuffer(raw, dtype=np.uint8).reshape(used, n).T
    return wide.view("<i8").ravel()


STATE_CELLS = 64 * 64 * 256
FOLLOW_CELLS = 16 * 16 * 64
MATCH_CELLS = 2 * 16 * 256 * 64


def counted(named: np.ndarray):
    """Counts of (state, code) over the documents that are learnt from, and after them of (match, held or not)."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(STATE_CELLS + MATCH_CELLS, dtype=np.int64)
        at, code = None, None
        for chunk, hashes, codes, part in by_chunk(batches):
            if chunk != at:
                at, code = chunk, with_anchors(codes, hashes, named)
            raw = part.filter(pc.invert(part.column("held_out"))).column("ids").to_pylist()
            if not raw:
                continue
            ids, lengths = unpacked(raw), np.array([len(x) // 4 for x in raw], dtype=np.int64)
            codes = code[ids]
            begins = np.cumsum(lengths) - lengths
            a, b = states(codes, begins, lengths)
            has, hit, cell = matches(ids, codes, begins, lengths)
            cells[:STATE_CELLS] += np.bincount(((a * 64 + b) * 256 + codes)[~hit], minlength=STATE_CELLS)
            cells[STATE_CELLS:] += np.bincount((2 * cell + hit)[has], minlength=MATCH_CELLS)
        some = np.flatnonzero(cells)
        for start in range(0, len(some), 100_000):
            at = some[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(cells[at])], ["cell", "n"])

    return rows


def spellings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit counts of the spelling of words, added up over what a task reads, in blocks of slots."""
    zeros, ones = np.zeros(len(ORDERS) << SLOT_BITS, np.int64), np.zeros(len(ORDERS) << SLOT_BITS, np.int64)
    words: list[bytes] = []

    def count(words: list[bytes]) -> None:
        zero, one = spelling_counts(words)
        np.add(zeros, zero, out=zeros)
        np.add(ones, one, out=ones)

    for batch in batches:
        words += batch.column("word").to_pylist()
        while len(words) >= COUNT_AT_ONCE:
            count(words[:COUNT_AT_ONCE])
            del words[:COUNT_AT_ONCE]
    count(words)
    for block, start in enumerate(range(0, len(zeros), SLOT_BLOCK)):
        counts = np.concatenate([zeros[start : start + SLOT_BLOCK], ones[start : start + SLOT_BLOCK]])
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([squeezed(counts)], pa.binary())], ["block", "counts"])


def added(rows: pa.Table) -> pa.Table:
    """The sum of what tasks have counted in a block of slots."""
    counts = np.zeros(2 * SLOT_BLOCK, dtype=np.int64)
    for x in rows.column("counts"):
        counts += loosened(x.as_py(), len(counts))
    return pa.table({"block": rows.column("block").slice(0, 1), "counts": pa.array([squeezed(counts)], pa.binary())})


def followed(spelling: SpellingModel):
    """What the spelling mixer learns from the words a task reads: weights and cells, and the bits each has seen."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        for batch in batches:
            words += batch.column("word").to_pylist()
            whole = len(words) - len(words) % LEARN_AT_ONCE
            spelling.learn(words[:whole])
            del words[:whole]
        spelling.learn(words)
        values, seen = spelling.mixer.learnt()
        some = np.flatnonzero(seen)
        part = np.full(len(some), TaskContext.get().partitionId(), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(some.astype(np.int32)), pa.array(values[some]), pa.array(seen[some])], ["part", "cell", "value", "seen"])

    return rows


def learnt_spelling(spelling: SpellingModel, words: DataFrame, n: int, part_words: int) -> SpellingModel:
    """The model with weights learnt from all of ``n`` words."""
    # Each part follows its words in one order, so that runs agree.
    dealt = words.repartition(max(1, -(-n // part_words)), "word").sortWithinPartitions(F.xxhash64("word"), "word")
    parts = dealt.mapInArrow(followed(spelling), "part int, cell int, value double, seen double")
    found = parts.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("part", "value", "seen"))).alias("parts"))

    def averaged(acc, x):
        seen = acc["seen"] + x["seen"]
        return F.struct((acc["mean"] + (x["value"] - acc["mean"]) * (x["seen"] / seen)).alias("mean"), seen.alias("seen"))

    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("seen"))
    found = found.select("cell", F.aggregate("parts", start, averaged)["mean"].alias("value")).toArrow()
    spelling.mixer.put(found.column("cell").to_numpy(), found.column("value").to_numpy())
    return spelling


def hashes_of_words(words: list[bytes]) -> np.ndarray:
    """Hashes as those that ``encoded`` writes."""
    if not words:
        return np.zeros(0, np.uint64)
    data, offsets = bytes_of(pa.array(words, pa.binary()))
    return span_hashes(prefix_sums(BYTE_VALUES[data]), offsets[:-1], offsets[1:]) >> np.uint64(64 - WORD_BITS)


def with_anchors(codes: np.ndarray, hashes: np.ndarray, named: np.ndarray) -> np.ndarray:
    """Codes of the words of a chunk, given the hashes of the anchors in order."""
    codes = codes.astype(np.int64)
    order = np.argsort(named)
    at = np.searchsorted(named[order], hashes)
    known = np.flatnonzero(named[order][np.minimum(at, len(named) - 1)] == hashes) if len(named) else []
    codes[known] = order[at[known]]
    return codes


def sizes_of_codes(anchors: dict[bytes, int]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(256, dtype=np.int64)
        for batch in batches:
            codes = [code_of(w, anchors) for w in batch.column("word").to_pylist()]
            np.add.at(sizes, codes, batch.column("c").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(sizes)], ["code", "n"])

    return rows


def spelt_codes(spelling: SpellingModel) -> np.ndarray:
    """Logarithms of the probabilities that a spelled word begins as the words of each code do."""
    space = [0x20, 9, 10, 11, 12, 13]
    letters = [b for b in range(256) if b not in space]
    begins = [bytes([a]) for a in letters] + [bytes([a, b]) for a in letters for b in letters]
    odds = np.concatenate([10 ** spelling.log10(begins[i : i + 4000], 2) for i in range(0, len(begins), 4000)])
    total = np.bincount([code_of(b, {}) for b in begins], odds, minlength=256)
    return np.log10(np.maximum(total, 1e-12))


def known_shares(count: np.ndarray, codes: np.ndarray, code_sizes: np.ndarray) -> np.ndarray:
    """Logarithms of the shares that words of the corpus have of their codes."""
    return np.log10(np.maximum(count, 1) / np.maximum(code_sizes[codes], 1)).astype(np.float32)


def valued(anchors: dict[bytes, int], code_sizes: np.ndarray, spelling: SpellingModel):
    """Adds to words their code and, if new, the logarithm of their share of it by spelling; ``known_shares`` has the others."""
    of_code = spelt_codes(spelling)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            count = batch.column("c").to_numpy(zero_copy_only=False)
            codes = np.array([code_of(w, anchors) for w in words], dtype=np.int64)
            share = np.zeros(len(words))
            new = np.flatnonzero(count == 0)
            for start in range(0, len(new), 2000):
                at = new[start : start + 2000]
                share[at] = spelling.log10([words[i] for i in at]) - of_code[codes[at]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(codes.astype(np.int32)), pa.array(share.astype(np.float32))],
                ["word", "c", "code", "share"],
            )

    return rows


LISTS = ("doc_id", "held_out", "n_bytes", "lengths")


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that a task reads of a chunk in a row: steps from number to number, counts, codes, and the shares of the new ones."""
    held: list[pa.RecordBatch] = []

    def flushed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        of, number, count, code, share = (rows.column(name).to_numpy() for name in ("of", "number", "c", "code", "share"))
        order = np.lexsort((number, of))
        of, number, count, code, share = of[order], number[order], count[order], code[order], share[order]
        cuts = np.flatnonzero(np.diff(of, prepend=of[0] - 1))
        spans = [slice(lo, hi) for lo, hi in zip(cuts, [*cuts[1:], len(of)])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(of[cuts]), pa.array([packed(np.diff(number[s], prepend=0)) for s in spans], pa.binary()),
                pa.array([packed(count[s], "<i8") for s in spans], pa.binary()), pa.array([packed(code[s], "u1") for s in spans], pa.binary()),
                pa.array([packed(share[s][count[s] == 0], "<f4") for s in spans], pa.binary()),
            ],
            ["of", "steps", "counts", "codes", "shares"],
        )

    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= GATHER_WORDS:
            yield flushed()
            held.clear()
            n = 0
    if n:
        yield flushed()


def packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents that a task reads at once of a chunk in a row."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(chunk)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(chunk)]):
            if lo < hi:
                part = batch.slice(lo, hi - lo)
                raw = part.column("ids").to_pylist()
                lengths = pa.array([len(x) // 4 for x in raw], pa.int32())
                lists = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), x) for x in (part.column("doc_id"), part.column("held_out"), part.column("n_bytes"), lengths)]
                ids = pa.compress(packed(unpacked(raw)), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([chunk[lo]]), *lists, pa.array([ids], pa.binary())], ["chunk", *LISTS, "ids"])


def unpacks(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The documents of rows that ``packs`` made, the numbers of their tokens and how many each has."""
    docs = pa.table({name: pc.list_flatten(rows.column(name)) for name in LISTS})
    sizes = [sum(x.as_py()) for x in rows.column("lengths")]
    raw = [pa.decompress(x.as_py(), decompressed_size=4 * n, codec="zstd", asbytes=True) for x, n in zip(rows.column("ids"), sizes)]
    return docs.drop_columns(["lengths"]), unpacked(raw), docs.column("lengths").to_numpy().astype(np.int64)


def spread(rows: pa.Table, code_sizes: np.ndarray) -> pa.Table:
    """The words of rows that ``gathered`` made, with the shares of the known ones."""
    steps, count, code, new = (
        unpacked(rows.column(name).to_pylist(), kind) for name, kind in (("steps", "<i4"), ("counts", "<i8"), ("codes", "u1"), ("shares", "<f4"))
    )
    sizes = np.array([len(x.as_py()) for x in rows.column("codes")], dtype=np.int64)
    number = np.cumsum(steps, dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    number -= np.repeat(number[first] - steps[first], sizes)
    share = known_shares(count, code, code_sizes)
    share[count == 0] = new
    return pa.table({"number": number, "c": count, "code": code, "share": share})


def found_again(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The total of each of the keys that ``followers`` has sent out."""
    keys, order = ranked(keys)
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
    if len(first) != len(totals):
        raise ValueError("words of a chunk lost on their way")
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.repeat(totals, np.diff(first, append=len(keys)))
    return out


def followed_by(words: np.ndarray, lengths: np.ndarray, totals: list[np.ndarray], key_bits: tuple[int, ...]) -> list[np.ndarray]:
    """How often the corpus has each token of the documents of a chunk after the one and the two before it."""
    begins = np.cumsum(lengths) - lengths
    return [found_again(context_keys(words, begins, lengths, order, key_bits[order]), totals[order]) for order in CONTEXTS]


def scored(table: np.ndarray, match: np.ndarray, unseen: float, train: int, distinct: int):
    """Scores of the documents of a chunk, given its new words, counts and codes of all and how often tokens
    come after the one and the two before them."""
    # New words are no anchors: the odds of the other codes after each state.
    new_codes = np.log10(np.maximum((10.0 ** table[:, :, ANCHORS + 1 :]).sum(axis=2), 1e-12))

    def chunk(
        docs: pa.Table, all_ids: np.ndarray, all_lengths: np.ndarray, new: pa.Table, count: np.ndarray, code: np.ndarray,
        code_sizes: np.ndarray, follows: list[np.ndarray],
    ) -> pa.Table:
        at = new.column("number").to_numpy()
        count[at], share = 0, known_shares(count, code, code_sizes).astype(np.float64)
        share[at] = new.column("share").to_numpy()
        base = np.log10((count + 1) / (train + distinct + 1))

        def some(docs: pa.Table, lengths: np.ndarray, first: int) -> pa.Table:
            n = docs.num_rows
            ids = all_ids[first : first + int(lengths.sum())]
            doc = np.repeat(np.arange(n), lengths)
            codes = code[ids]
            begins = np.cumsum(lengths) - lengths
            a, b = states(codes, begins, lengths)
            has, hit, cell = matches(ids, codes, begins, lengths)
            known = count[ids] > 0
            fresh = np.log10(unseen) - new_codes[a, b]
            parts = share[ids] + table[a, b, codes] + np.where(known, np.log10(1 - unseen), fresh)
            again = np.where(has, match[cell, hit.astype(np.int64)], 0)
            score = np.bincount(doc, np.where(hit, 0, parts) + again, minlength=n)

            # By contexts of words: what followed the last two, then an earlier place of the text, then what followed the last one.
            own = np.repeat(~docs.column("held_out").to_numpy(), lengths).astype(np.int64)
            one, two = (x[first : first + len(ids)] - own for x in follows)
            at_first = np.zeros(len(ids), dtype=bool)
            at_first[begins] = True
            after_two = np.where(at_first, 0, np.roll(one, 1))
            after_one = np.where(at_first, count[ids[-1]], np.roll(count[ids], 1)) - own
            rest, fixed, coded = np.ones(len(ids), dtype=bool), np.zeros(len(ids)), {}
            for order, after, times in ((2, after_two, two), (1, after_one, one)):
                with_context = after > 0
                comes = with_context & (times > 0)
                size = np.where(after < 1 << 15, WIDE_LOG2[np.clip(after, 0, (1 << 15) - 1)], 15)
                cells = cells_of(with_context, comes, size, 16, begins, lengths)
                bits = np.where(rest & with_context, 2 * cells + comes, -1)
                # Their order says nothing any more; sorted they take less room.
                at = np.flatnonzero(bits >= 0)
                bits = np.sort(doc[at] << 16 | bits[at])
                cuts = np.searchsorted(bits, np.arange(1, n) << 16)
                coded[order] = [packed(x, "<u2") for x in np.split((bits & 0xFFFF).astype(np.uint16), cuts)]
                seen = rest & comes
                fixed[seen] += np.log10(np.minimum(times, after)[seen] / after[seen])
                rest &= ~comes
                if order == 2:
                    fixed += np.where(rest, again, 0)
                    rest &= ~hit
            fixed += np.where(rest, parts, 0)
            return pa.table({
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": lengths,
                "n_known": np.bincount(doc, known, minlength=n).astype(np.int64), "train_tokens": np.full(n, train, np.int64),
                "base_score": np.bincount(doc, base[ids], minlength=n), "score": score, "n_bytes": docs.column("n_bytes"),
                "fixed": np.bincount(doc, fixed, minlength=n), "coded1": pa.array(coded[1], pa.binary()), "coded2": pa.array(coded[2], pa.binary()),
            })

        # Some documents at a time, or a long one: the work on them takes ten times their room.
        first = np.cumsum(all_lengths) - all_lengths
        starts = range(0, docs.num_rows, DOCS_AT_ONCE)
        return pa.concat_tables([some(docs.slice(start, DOCS_AT_ONCE), all_lengths[start : start + DOCS_AT_ONCE], int(first[start])) for start in starts])

    return chunk


PARTS_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "n_bytes long, fixed double, coded1 binary, coded2 binary"
)
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "context_score double, bits_per_byte double"
)


def coded_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (cell, comes or not) of the contexts of one and of two words."""
    counts = np.zeros((len(CONTEXTS), 2 * FOLLOW_CELLS), dtype=np.int64)
    for batch in batches:
        for i, order in enumerate(CONTEXTS):
            counts[i] += np.bincount(unpacked(batch.column(f"coded{order}").to_pylist(), "<u2"), minlength=2 * FOLLOW_CELLS)
    counts = counts.ravel()
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["cell", "n"])


def finished(follow: list[np.ndarray]):
    """Adds what the bits of the contexts of words cost to the scores."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, score = batch.num_rows, batch.column("fixed").to_numpy().copy()
            for order, values in zip(CONTEXTS, follow):
                raw = batch.column(f"coded{order}").to_pylist()
                doc = np.repeat(np.arange(n), [len(x) // 2 for x in raw])
                score += np.bincount(doc, values[unpacked(raw, "<u2")], minlength=n)
            kept = [batch.column(name) for name in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
            per_byte = -score * np.log2(10) / np.maximum(1, batch.column("n_bytes").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score), pa.array(per_byte)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "context_score", "bits_per_byte"],
            )

    return rows


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def corpus_scores(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT, part_words: int = PART_WORDS) -> DataFrame:
    """Scores of every row (``doc_id``, ``text``); rows are learnt from unless the CRC of their id,
    modulo the first number of ``held_out``, is the second.

    A null or empty text is an end alone; a null id counts as an empty text for
    the CRC. Repeated rows are learnt from and scored each. With nothing to
    learn from, no token is known and words are spelled with equal odds.
    Other columns are ignored.
    """
    with configured(docs.sparkSession, BRIEF_SHUFFLES):
        scores, follow = learnt_scores(docs, held_out, part_words)
    return scores.mapInArrow(finished(follow), SCHEMA)


def learnt_scores(docs: DataFrame, held_out: tuple[int, int], part_words: int) -> tuple[DataFrame, list[np.ndarray]]:
    """A table of what scores are made of, but for what the bits of contexts of words cost, and this."""
    spark = docs.sparkSession
    small_batches(spark)
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = columns_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc % held_out[0] == held_out[1]).alias("held_out"), text_bytes().alias("body")
    )
    kinds = "chunk long, doc_id long, held_out boolean, n_bytes long, ids binary, codes binary, word binary, number int, train long, hashes binary"
    with configured(spark, ONE_FILE):
        chunks = staged(rows.mapInArrow(encoded, kinds), "chunks", compression="zstd")
    entries = chunks.where("word IS NOT NULL").select("chunk", "word", "number", "train")
    vocabulary = staged(entries.groupBy("word").agg(F.sum("train").alias("c")), "words")
    seen = vocabulary.where("c > 0")
    total = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum((F.col("c") == 1).cast("int")), F.lit(0))).first()
    train, distinct, once = int(total[0]), int(total[1]), int(total[2])
    top = seen.orderBy(F.desc("c"), "word").limit(ANCHORS).collect()
    anchors = {bytes(r["word"]): i for i, r in enumerate(top)}

    # Predictors of codes.
    named = hashes_of_words(list(anchors))
    tokens = chunks.where("ids IS NOT NULL OR hashes IS NOT NULL").select("chunk", "held_out", "ids", "codes", "number", "hashes")
    cells = tokens.mapInArrow(counted(named), "cell int, n long")
    with configured(spark, WHOLE_FILES):
        cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(STATE_CELLS + MATCH_CELLS)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    match = MatchModel(counts[STATE_CELLS:]).log10()
    table = CodeModel(counts[:STATE_CELLS].reshape(64, 64, 256)).log10()

    # Training tokens of each code.
    sized = seen.mapInArrow(sizes_of_codes(anchors), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    code_sizes = np.zeros(256)
    for code, n in sized:
        code_sizes[code] = n

    # Predictors of spellings.
    slots = seen.select("word").mapInArrow(spellings, "block int, counts binary").groupBy("block").applyInArrow(added, "block int, counts binary")
    bits = np.zeros((2, len(ORDERS) << SLOT_BITS), dtype=np.int64)
    for block, counts in slots.collect():
        bits[:, block * SLOT_BLOCK : (block + 1) * SLOT_BLOCK] = loosened(counts, 2 * SLOT_BLOCK).reshape(2, -1)
    if bits.max(initial=0) < 1 << 31:
        bits = bits.astype(np.int32)
    # Tasks that learn and tasks that score read one copy of the counts.
    spelling = learnt_spelling(SpellingModel(*bits, shared=spark.sparkContext.broadcast(bits)), seen.select("word"), distinct, part_words)

    # Words by themselves come to chunks only if they are new, ...
    new = vocabulary.where("c = 0").mapInArrow(valued(anchors, code_sizes, spelling), "word binary, c long, code int, share float")
    numbers = entries.where("train = 0").select("chunk", "word", "number").join(new, "word").select(F.col("chunk").alias("of"), "number", "c", "code", "share")
    # The words of a chunk meet its documents packed: a few bytes each.
    numbers = numbers.mapInArrow(gathered, "of long, steps binary, counts binary, codes binary, shares binary")
    texts = chunks.where("ids IS NOT NULL").select("chunk", "doc_id", "held_out", "n_bytes", "ids")
    texts = texts.mapInArrow(packs, "chunk long, doc_id array<long>, held_out array<boolean>, n_bytes array<long>, lengths array<int>, ids binary")
    unseen = (once + 1) / (train + 2)
    score = scored(table, match, unseen, train, distinct)

    # ... all others, and what follows one and two words, by their hashes: from all chunks and back to them.
    hashes = chunks.where("hashes IS NOT NULL").select(F.col("chunk").alias("of"), F.col("number").alias("n"), "codes", "hashes")
    parts = max(1, hashes.count())
    widths = key_bits(train)
    follows = tokens.mapInArrow(followers(parts, widths), "of long, part int, n int, keys binary, totals binary")
    follows = follows.groupBy("part").applyInArrow(totalled, "of long, part int, n int, totals binary")

    def parted(docs: pa.Table, found: pa.Table) -> pa.Table:
        words = found.filter(pc.is_valid(found.column("steps")))
        own = found.filter(pc.is_valid(found.column("hashes"))).select(["n", "codes", "hashes"]).to_pylist()[0]
        back = found.filter(pc.is_valid(found.column("part"))).select(["part", "n", "totals"]).sort_by("part").to_pylist()
        totals = [np.concatenate([loosened(r["totals"], r["n"]) for r in back if r["part"] // parts == order]) for order in (0, *CONTEXTS)]
        hashes = hashes_of(own["hashes"], own["n"])
        codes = with_anchors(np.frombuffer(own["codes"], np.uint8), hashes, named)
        docs, ids, lengths = unpacks(docs)
        follows = followed_by(hashes[ids], lengths, totals, widths)
        return score(docs, ids, lengths, spread(words, code_sizes), found_again(hashes, totals[0]), codes, code_sizes, follows)

    found = numbers.unionByName(follows, allowMissingColumns=True).unionByName(hashes, allowMissingColumns=True)
    scores = texts.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(parted, PARTS_SCHEMA)
    with configured(spark, WHOLE_FILES):
        scores = staged(scores, "scores", compression="zstd")

    # Predictors of whether a word comes that followed its context before.
    cells = scores.where("NOT held_out").select("coded1", "coded2").mapInArrow(coded_counts, "cell int, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(CONTEXTS) * 2 * FOLLOW_CELLS)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return scores, [FollowModel(own).log10().ravel() for own in counts.reshape(len(CONTEXTS), -1)]
