"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A prefix of a text has one BPE encoding, whose last token ends at that place and
fits the encoding of what stands before it: two tokens fit if the merges turn
their joined bytes into just these two. The transducer reads bytes. Its state
holds the places where a token that is still open may have begun, each with the
tokens leading to it; tokens on which all these places agree are emitted, so
lookahead never exceeds the longest token. States and transitions are made when
first needed, up to a bound; a piece that needs others then is run through the
undeterminised machine.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import columns_of, sliced, small_batches, text_bytes

# Entries a Python worker keeps. When the table of states is full, what it lacks is searched for; the
# other tables drop old entries. None of this changes a result.
STATES = 60_000
PIECES = 400_000
PAIRS = 400_000
BLOCK = 1 << 16

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes pieces of text, one byte after the other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # A trie of the tokens: child by (node, byte), the token a node ends, whether tokens go on from it.
        self.child: dict[int, int] = {}
        self.token_at, self.goes_on = [-1], [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.goes_on[node] = True
                after = self.child.setdefault(node << 8 | byte, len(self.token_at))
                if after == len(self.token_at):
                    self.token_at.append(-1)
                    self.goes_on.append(False)
                node = after
            self.token_at[node] = rank
        self.fits: dict[tuple[int, int], bool] = {}
        self.splits: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self.reset()

    def reset(self) -> None:
        # A state: the last emitted token, and for every place where an open token may have begun,
        # latest first, the trie node reached from it and the tokens before it that are not emitted yet.
        self.states = [(-1, ((0, ()),))]
        self.numbers = {self.states[0]: 0}
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def merged(self, data: bytes, below: float = float("inf")) -> list[bytes]:
        """The merges of ranks under ``below`` applied to a few bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(
                ((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1], below)) < below),
                default=None,
            )
            if best is None:
                break
            at = best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; none for a byte or a token no merge reaches."""
        known = self.splits.get(token, False)
        if known is False:
            parts = self.merged(token, self.ranks[token])
            known = self.splits[token] = tuple(parts) if len(parts) == 2 else None
        return known

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The tokens that stand at the left (0) or right (1) end while ``token`` is merged,
        each with the rank of the merge that takes it in."""
        key = token, side
        known = self.edges.get(key)
        if known is None:
            parts = self.split(token)
            known = [] if parts is None else [*self.edge(parts[side], side)[:-1], (parts[side], self.ranks[token])]
            known = self.edges[key] = [*known, (token, float("inf"))]
        return known

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens as they are; ``left`` -1 is the beginning.

        The facing ends of both are followed through the merges in order of
        rank; of equal ranks the merge further left comes first.
        """
        b = self.tokens[right]
        known = len(b) == 1 or self.split(b) is not None
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        if known and left >= 0:
            ranks, ends, begins = self.ranks, self.edge(self.tokens[left], 1), self.edge(b, 0)
            i = j = 0
            while True:
                (x, x_until), (y, y_until) = ends[i], begins[j]
                rank = ranks.get(x + y)
                if rank is not None and rank < x_until and rank <= y_until:
                    known = False
                    break
                if x_until <= y_until:
                    if i + 1 == len(ends):
                        break
                    i += 1
                else:
                    j += 1
        self.fits[left, right] = known
        return known

    def step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make one transition."""
        last, places = self.states[number]
        child, token_at, goes_on, fits = self.child, self.token_at, self.goes_on, self.fits
        ended, after = None, []
        for node, pending in places:
            reached = child.get(node << 8 | byte)
            if reached is None:
                continue
            if ended is None and (token := token_at[reached]) >= 0:
                pair = (pending[-1] if pending else last), token
                fit = fits.get(pair)
                if self.fit(*pair) if fit is None else fit:
                    ended = (*pending, token)
            if goes_on[reached]:
                after.append((reached, pending))
        if ended is None:
            raise ValueError("the ranks lack a single byte")
        common = ended
        for _, pending in after:
            n = 0
            for x, y in zip(common, pending):
                if x != y:
                    break
                n += 1
            if n < len(common):
                common = common[:n]
                if not n:
                    break
        if common:
            n, last = len(common), common[-1]
            state = last, ((0, ended[n:]), *[(node, pending[n:]) for node, pending in after])
        else:
            state = last, ((0, ended), *after)
        target = self.numbers.get(state)
        if target is None:
            target = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        made = self.steps[number][byte] = target, common
        return made

    def search(self, piece: bytes) -> list[int]:
        """The one path of the machine over a piece, found depth first, longest tokens first, without
        making states. A place that led nowhere is not entered again, so this takes linear time."""
        child, token_at, fits, size = self.child, self.token_at, self.fits, len(piece)
        path: list[int] = []
        tried: list[tuple[int, list[tuple[int, int]], int]] = []
        dead: set[int] = set()
        at, last, fresh, choices = 0, -1, True, []
        while at < size:
            if fresh:
                node, choices = 0, []
                for end in range(at, size):
                    node = child.get(node << 8 | piece[end])
                    if node is None:
                        break
                    if (token := token_at[node]) >= 0:
                        choices.append((end + 1, token))
            fresh = False
            while choices:
                end, token = choices.pop()
                if end in dead:
                    continue
                fit = fits.get((last, token))
                if self.fit(last, token) if fit is None else fit:
                    tried.append((at, choices, last))
                    path.append(token)
                    at, last, fresh = end, token, True
                    break
            if not fresh:
                if not tried:
                    raise ValueError("the ranks lack a single byte")
                dead.add(at)
                at, choices, last = tried.pop()
                path.pop()
        return path

    def encode(self, piece: bytes) -> list[int]:
        out: list[int] = []
        number, steps, full = 0, self.steps, len(self.states) >= STATES
        for byte in piece:
            move = steps[number].get(byte)
            if move is None:
                if full:
                    return self.search(piece)
                move = self.step(number, byte)
            number = move[0]
            if move[1]:
                out += move[1]
        out += self.states[number][1][0][1]
        return out


# Continuation bytes that follow each lead byte of UTF-8; anything else stands alone.
FOLLOWERS = [0] * 0xC2 + [1] * 30 + [2] * 16 + [3] * 5 + [0] * 11


class Utf8Stream:
    """Incremental decoder of token ids: gives out whole characters only and carries the rest over."""

    def __init__(self, tokens: dict[int, bytes]):
        top = max(tokens) + 1
        self.sizes = np.array([len(tokens.get(i, b"")) for i in range(top)], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(top)), dtype=np.uint8)
        self.carried = b""

    def feed(self, ids: np.ndarray, last: bool = False) -> bytes:
        """Bytes of the characters completed so far; with ``last`` also an unfinished rest."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ids) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        data = self.carried + self.raw[places].tobytes()
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                cut -= back if FOLLOWERS[byte] >= back else 0
                break
        if last:
            cut = len(data)
        self.carried = data[cut:]
        return data[:cut]


class Packed(dict):
    """Ids of pieces as four bytes each, filled when a piece is first looked up. Two generations
    of bounded size: pieces that nobody asked for while the younger one filled up are dropped."""

    def __init__(self, machine: Transducer):
        self.machine = machine
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            got = np.array(self.machine.encode(piece.encode("utf-8")), dtype=np.int32).tobytes()
        if len(self) >= PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = got
        return got


class Codec:
    """Texts to ids and back, with a bounded memory of pieces."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.machine = Transducer(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.pieces = Packed(self.machine)
        self.decimal = {rank: str(rank) for rank in self.machine.tokens}
        self.stream = Utf8Stream(self.machine.tokens)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.find(text))), dtype=np.int32)

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids joined by commas."""
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids.tolist())).encode()).hexdigest()

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """Bytes of the ids, in blocks that end between characters."""
        for start in range(0, len(ids), BLOCK):
            yield self.stream.feed(ids[start : start + BLOCK])
        yield self.stream.feed(ids[:0], last=True)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encoded(path: str, pattern: str, with_ids: bool):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for part in sliced(batches, "body"):
            counts, id_sums, text_sums, all_ids = [], [], [], []
            for body in part.column("body"):
                ids = coder.encode(body.as_py().decode("utf-8", "replace"))
                counts.append(len(ids))
                id_sums.append(coder.digest(ids))
                digest = hashlib.sha256()
                for block in coder.decode(ids):
                    digest.update(block)
                text_sums.append(digest.hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                flat = pa.array(np.concatenate([np.zeros(0, np.int32), *all_ids]), pa.int32())
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Token counts and digests of ids and decoded bytes per document (``doc_id``, ``text``).

    ``path`` names a rank file every executor has, ``pattern`` splits a text into
    the pieces that are encoded separately. A null or empty text has no tokens;
    bytes that are not UTF-8 count as U+FFFD; texts of any length are encoded
    whole; repeated rows give repeated results; other columns are ignored.
    ``with_ids`` adds the ids themselves.
    """
    small_batches(docs.sparkSession)
    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes().alias("body"))
    return rows.mapInArrow(encoded(path, pattern, with_ids), SCHEMA + (", ids array<int>" if with_ids else ""))
