"""Shards of near equal size by sampled splitters.

Rows are ordered by the hash of their text, then by id. A size-weighted sample
of these keys gives quantile boundaries; rows are dealt to the ranges between
them, ranges that turn out overfull (a hot text, an unlucky sample) are
subdivided by a new sample from inside them, and the exact bytes before each
range and each row decide on the shard. Only narrow rows are moved; the driver
sees a sample and a total per range, both bounded by ``MAX_RANGES``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import columns_of, staged, text_bytes

ROW_BYTES = 8
RANGES_PER_SHARD = 16
RANGE_BYTES = 64 << 20
MAX_RANGES = 20_000
OVERSAMPLE = 32
OVERFULL = 2.0
ROUNDS = 8


def ordered_keys(table: pa.RecordBatch) -> np.ndarray:
    """The keys (text hash, id, number) as bytes that sort the same way."""
    parts = np.empty((table.num_rows, 3), dtype=">u8")
    for i, name in enumerate(("h", "id", "n")):
        parts[:, i] = table.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.frombuffer(parts.tobytes(), dtype="S24")


def in_ranges(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """The rows with the number of the range each lies in."""

    def tagged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(splitters, ordered_keys(batch), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "range"])

    return rows.mapInArrow(tagged, rows.schema.simpleString()[7:-1] + ",range:int")


def sampled_keys(rows: DataFrame, chance, salt: int) -> np.ndarray:
    """Sorted keys of a sample that takes each row with the given chance, the same on each run."""
    draw = (F.xxhash64("h", "id", "n", F.lit(salt)).bitwiseAND((1 << 52) - 1)) / F.lit(float(1 << 52))
    got = rows.where(draw < chance).select("h", "id", "n").toArrow()
    keys = [ordered_keys(b) for b in got.to_batches() if b.num_rows]
    return np.sort(np.concatenate(keys)) if keys else np.zeros(0, "S24")


def quantiles(keys: np.ndarray, parts: int) -> np.ndarray:
    """Keys that cut a sorted sample in ``parts``."""
    if not len(keys) or parts < 2:
        return keys[:0]
    return np.unique(keys[(np.arange(1, parts) * len(keys)) // parts])


def find_splitters(rows: DataFrame, total: int, shards: int) -> tuple[np.ndarray, list]:
    """Splitters whose ranges are not overfull, and (range, bytes, rows) of each range."""
    ranges = int(min(MAX_RANGES, max(RANGES_PER_SHARD * shards, total // RANGE_BYTES)))
    share = total / ranges
    weight = F.col("size") * F.lit(OVERSAMPLE / share)
    splitters = quantiles(sampled_keys(rows, weight, 0), ranges)
    for salt in range(1, ROUNDS + 2):
        # What is returned is counted for these very splitters, also when the rounds end before the overfull ranges.
        tagged = in_ranges(rows, splitters)
        sizes = tagged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("c"), F.max("size").alias("m")).collect()
        full = [r for r in sizes if r.b > OVERFULL * share and r.b > OVERFULL * r.m]
        if not full or salt > ROUNDS:
            break
        inside = tagged.where(F.col("range").isin([r["range"] for r in full]))
        keys = sampled_keys(inside, weight, salt)
        at = np.searchsorted(splitters, keys, side="right")
        new = [quantiles(keys[at == r["range"]], int(np.ceil(r.b / share))) for r in full]
        found = np.unique(np.concatenate([splitters, *new]))
        if len(found) == len(splitters):
            break
        splitters = found
    return splitters, sorted((r["range"], r.b, r.c) for r in sizes)


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard and slot of every row (``doc_id``, ``text``) under the law ``bytes``.

    A shard differs from the mean size by no more than the largest row. A null text has no
    bytes, an empty table gives no rows, equal texts stand next to each other
    (split only where a shard ends), repeated rows each get a slot, rows
    without an id come first among equal texts. Other columns are ignored.
    """
    spark = docs.sparkSession
    body = text_bytes()
    rows = columns_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.monotonically_increasing_id().alias("n"),
    )
    rows = staged(rows, "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 1
    splitters, sizes = find_splitters(rows, total, shards)
    before, lines, at_bytes, at_rows = [], {r: (b, c) for r, b, c in sizes}, 0, 0
    for r in range(len(splitters) + 1):
        before.append((r, at_bytes, at_rows))
        got = lines.get(r, (0, 0))
        at_bytes, at_rows = at_bytes + got[0], at_rows + got[1]
    places = spark.createDataFrame(before, "range int, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("h", "id", "n")
    ranked = (
        in_ranges(rows, splitters)
        .withColumns({
            "row": F.row_number().over(order) - 1,
            "upto": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        })
        .join(F.broadcast(places), "range")
        .select(
            "doc_id", "size", "text_crc32",
            F.least(
                F.lit(shards - 1), F.floor((F.col("bytes_before") + F.col("upto") - F.col("size") / 2) * shards / F.lit(total))
            ).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("row")).alias("rank"),
        )
    )
    ranked = staged(ranked, "shard-ranks")
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
