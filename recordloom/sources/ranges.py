"""A master table in ranges of its key, of which a merge rewrites only those it touches.

Rows lie below ``data/version=V/range=R``: the range is the key divided by the
table's width, the version is the merge that wrote it. What makes up a version
of the table is a manifest below ``versions``: for each range the version that
holds it, its rows and its largest key, and one line with the table's width and
columns. A merge writes the touched ranges under
its own number, then its manifest; earlier versions stay readable, and a merge
that is done again writes the same once more.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from ..operators.keys import assign_sequential_ids
from ..operators.upsert import new_rows, update_master

VERSION, RANGE = "version", "range"
# Rows without a key are a range of their own.
NO_KEY = -1
WIDTH = 1 << 20
_MANIFEST = "range bigint, held bigint, rows bigint, last bigint, width bigint, columns string"


def _range_of(key: Column, width: int) -> Column:
    return F.coalesce(F.floor(key / F.lit(width)).cast("bigint"), F.lit(NO_KEY).cast("bigint"))


def _write(df: DataFrame, path: str, key: str, version: int, width: int) -> DataFrame:
    """Write rows as ranges of a version; the lines of its manifest for them and for the table."""
    target = f"{path}/data/{VERSION}={version}"
    # Rows of one range come together, and adaptive execution splits large ranges.
    df.withColumn(RANGE, _range_of(F.col(key), width)).repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(target)
    spark = df.sparkSession
    columns = T.StructType([df.schema[key], T.StructField(RANGE, T.LongType())])
    written = spark.read.schema(columns).parquet(target).groupBy(RANGE).agg(
        F.lit(version).cast("bigint").alias("held"), F.count("*").alias("rows"), F.max(key).cast("bigint").alias("last"),
        F.lit(None).cast("bigint").alias("width"), F.lit(None).cast("string").alias("columns"),
    )
    return written.unionByName(spark.createDataFrame([(None, version, 0, None, width, df.schema.json())], _MANIFEST))


def _store_manifest(lines: DataFrame, path: str, version: int) -> None:
    lines.coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/{VERSION}={version}")


def _manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{path}/versions/{VERSION}={version}")


def _lines(spark: SparkSession, path: str, version: int) -> tuple[list, Row]:
    """The lines of the ranges of a version, and the one of the table."""
    found = _manifest(spark, path, version).collect()
    return [line for line in found if line[RANGE] is not None], next(line for line in found if line[RANGE] is None)


def create_master(df: DataFrame, path: str, key: str, width: int = WIDTH) -> None:
    """Version 0 of a table. Keys are integers; ``width`` of them are a range."""
    if width < 1:
        raise ValueError("a range has at least one key")
    _store_manifest(_write(df, path, key, 0, width), path, 0)


def latest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest version."""
    return spark.read.parquet(f"{path}/versions").agg(F.max(VERSION)).first()[0]


def _rows_of(spark: SparkSession, path: str, lines: list, columns: T.StructType) -> DataFrame:
    """The rows of some lines of a manifest. Ranges of others are not read: both numbers are partitions.

    The table lists its partitions on the driver anyway; these lines are no more.
    """
    if not lines:
        return spark.createDataFrame([], columns)
    held: dict[int, list[int]] = {}
    for line in lines:
        held.setdefault(line["held"], []).append(line[RANGE])
    wanted = [(F.col(VERSION) == v) & F.col(RANGE).isin(ranges) for v, ranges in sorted(held.items())]
    condition = reduce(lambda a, b: a | b, wanted, F.lit(False))
    parts = [T.StructField(name, T.LongType()) for name in (VERSION, RANGE)]
    return spark.read.schema(T.StructType([*columns, *parts])).parquet(f"{path}/data").filter(condition).drop(VERSION, RANGE)


def read_master(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest by default."""
    version = latest_version(spark, path) if version is None else version
    lines, table = _lines(spark, path, version)
    return _rows_of(spark, path, lines, T.StructType.fromJson(json.loads(table["columns"])))


def merge_master(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    order: list[str],
    base: int | None = None,
    **options,
) -> int:
    """Merge updates into the table as :func:`upsert` does; the number of the new version.

    Read and written are only the ranges that hold a key of the updates, and the
    last one, where new keys begin. ``base`` is the version to build on, the
    newest by default; the new one is the next number after it, so merging the
    same updates into the same base again replaces it. ``options`` go to
    :func:`update_master`.
    """
    base = latest_version(spark, path) if base is None else base
    lines, table = _lines(spark, path, base)
    manifest = _manifest(spark, path, base).filter(F.col(RANGE).isNotNull())
    width, columns = table["width"], T.StructType.fromJson(json.loads(table["columns"]))
    highest = max((line["last"] for line in lines if line["last"] is not None), default=0)
    keys = updates.filter(F.col(key).isNotNull()).select(_range_of(F.col(key), width).alias(RANGE)).distinct()
    known = {line[RANGE] for line in lines}
    last = max(known - {NO_KEY}, default=None)
    # Of the ranges of the updates those the table has: no more than its partitions.
    touched = {row[RANGE] for row in keys.join(F.broadcast(manifest.select(RANGE)), RANGE, "left_semi").collect()} | ({last} - {None})
    master = _rows_of(spark, path, [line for line in lines if line[RANGE] in touched], columns)
    fresh = assign_sequential_ids(new_rows(master, updates, key), key, highest + 1, order)
    updated = update_master(master, updates, key, order, **options)
    inserted = fresh.select(*[c for c in fresh.columns if c in updated.columns])
    version = base + 1
    written = _write(updated.unionByName(inserted, allowMissingColumns=True), path, key, version, width)
    kept = manifest.filter(~F.col(RANGE).isin(list(touched))) if touched else manifest
    _store_manifest(kept.unionByName(written), path, version)
    return version
