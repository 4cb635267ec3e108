"""What several operators share: words, batches of bounded size, stage tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import scratch_path

# Work on texts takes some fifty times their room.
BATCH_BYTES = 2 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a size that whole texts allow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by_bytes(df: DataFrame, name: str, limit: int = BATCH_BYTES) -> DataFrame:
    """Like ``staged``, for rows that hold whole texts or sets to Python: Arrow batches end at so many bytes, too."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(limit))
    try:
        return staged(df, name)
    finally:
        conf.set(key, before)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def sliced(batches: Iterable[pa.RecordBatch], *columns: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most ``limit`` bytes of binary columns, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = sum(np.diff(offsets_of(batch.column(c))) for c in columns)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        yield batch.slice(start)


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of a binary column."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in one array, and the offsets of its rows in it."""
    offsets = offsets_of(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that columns with clashing names never matter."""
    return df.select(*[F.col(f"`{n}`") for n in names])


# Rolling hashes: byte or word i weighs BASE**i modulo 2**64; a span's sum is shifted back to
# weight 0 by the inverse powers, so equal spans have equal hashes wherever they stand.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def powers(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of BASE, or of its inverse."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 16), BASE if kind == "base" else INVERSE, dtype=np.uint64)
        factors[0] = 1
        have = _powers[kind] = np.multiply.accumulate(factors)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit hash over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Weighted prefix sums of 64-bit values for ``span_hashes``."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers("base", len(values)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end)."""
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * powers("inverse", len(sums))[starts] + lengths)


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the words before each row (one more entry than rows).

    ``between`` tells for each byte whether it stands between words.
    """
    inside = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(between[data], out=inside[:-1])
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside[:-1]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it stands twice or more, and whether it stood earlier."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, again
