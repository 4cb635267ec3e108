"""Readers of record files with explicit schemas."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.identifiers import is_blank
from ..functions.lists import lossy_list_literal, parse_list_literal
from ..operators.routing import RESCUED

# Quoting of the CSV files, doubled quotes inside quoted fields.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}

_CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
BATCH_FILE = "_metadata.file_path"

# Columns that readers add on request: what could not be read of a row, and where the row stood.
ARRIVAL = "_arrival"
RESCUED_TYPE = "array<struct<file:string,field:string,raw:string,reason:string>>"
RAGGED = "not as many fields as the header"
NO_RECORD = "not a JSON record"


def _typed(column: Column, kind: T.DataType) -> Column:
    """A text as a value of the wanted type; lists are literals, other nested values JSON."""
    if isinstance(kind, T.ArrayType):
        return parse_list_literal(column, kind.elementType.simpleString())
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.from_json(column, kind)
    return column if isinstance(kind, T.StringType) else column.try_cast(kind)


def as_schema(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema that a frame of texts has, with their types."""
    return texts.select(
        [_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema if f.name in texts.columns]
    )


def _loss(column: Column, kind: T.DataType) -> tuple[Column, str] | None:
    """Whether a non-blank text is lost, in whole or in part, as a value of the type, and what it is not."""
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.ArrayType):
        return lossy_list_literal(column, kind.elementType.simpleString()), "not a list"
    return ~is_blank(F.trim(column)) & _typed(column, kind).isNull(), f"not a {kind.simpleString()}"


def _rescued(schema: T.StructType, names: list[str], file: Column, corrupt: Column | None, broken: str) -> Column:
    """What a row of texts loses when it is read with its types, and the whole text of a ``broken`` one."""

    def entry(field: str | None, raw: Column, reason: str) -> Column:
        values = {"file": file, "field": F.lit(field), "raw": raw, "reason": F.lit(reason)}
        return F.struct(*[v.cast("string").alias(n) for n, v in values.items()])

    found = []
    for f in schema:
        loss = _loss(F.col(f.name), f.dataType) if f.name in names else None
        if loss is not None:
            found.append(F.when(loss[0], entry(f.name, F.col(f.name), loss[1])))
    if corrupt is not None:
        # Spark reads no corrupt texts alone; any other column will do.
        whole = F.coalesce(corrupt, F.col(names[0])) if names else corrupt
        found.append(F.when(corrupt.isNotNull(), entry(None, whole, broken)))
    return F.array_compact(F.array(*found)).cast(RESCUED_TYPE) if found else F.array().cast(RESCUED_TYPE)


def _arrived() -> Column:
    """Where a row stood, in the order of arrival: by time of the file, then file, then place in it.

    The number counts the rows of a task, so it orders those of one block of a file.
    """
    return F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )


def _csv_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, names: list[str], multi_line: bool,
    rescue: bool, arrival: bool, **options,
) -> DataFrame:
    """Rows of CSV files with the columns ``names``: those of the schema, typed, and what is asked for beside them."""
    fields = [T.StructField(n, T.StringType()) for n in names]
    if rescue:
        fields.append(T.StructField(_CORRUPT, T.StringType()))
    reader = spark.read.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", _CORRUPT)
    raw = reader.csv(path, multiLine=multi_line, **options, **CSV_OPTIONS)
    kept = [_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema if f.name in names]
    file = F.col("_metadata.file_name")
    if rescue:
        kept.append(_rescued(schema, names, file, F.col(_CORRUPT), RAGGED).alias(RESCUED))
    if arrival:
        kept.append(_arrived().alias(ARRIVAL))
    return raw.select(*kept, file.alias(SOURCE_FILE))


def read_csv_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True,
    rescue: bool = False, arrival: bool = False,
) -> DataFrame:
    """CSV files with a header and the columns of ``schema``.

    An empty field is missing, quoted or not. Texts may hold line breaks; pass ``multi_line=False`` for files without
    them, which Spark can then split.

    What a type cannot hold becomes null or the empty list. ``rescue`` keeps it
    in ``_rescued``, a list of structs of file, field, raw text and reason, where
    a line with too few or too many fields is entered whole (without a field);
    the list is empty for a row that lost nothing. ``arrival`` adds
    ``_arrival``, a struct that orders rows by time of their file, file and
    place in it.
    """
    rows = _csv_rows(spark, path, schema, schema.names, multi_line, rescue, arrival, enforceSchema=False)
    return rows.drop(SOURCE_FILE)


def _other_layouts(lines: DataFrame) -> list[str]:
    """Files that hold JSON records otherwise than one per line, told by the first line of each with a record in it:
    an array begins there with more behind it, or a record that goes on in the next line."""
    text = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    heads = lines.filter(F.col("_block") == 0).select("_file", text.alias("text"), F.monotonically_increasing_id().alias("row"))
    heads = heads.filter(~F.col("text").isin("[", "")).groupBy("_file").agg(F.min_by("text", "row").alias("text"))
    array = F.col("text").startswith("[") & ~F.col("text").rlike(r"^\[\s*\]$")
    return [row["_file"] for row in heads.filter(array | F.col("text").rlike(r"^\{(.*[,:{\[])?$")).select("_file").collect()]


def _json_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None, rescue: bool = False, arrival: bool = False,
) -> DataFrame:
    """Records of JSON files in any layout, with the file in ``_file``."""

    def reader():
        return spark.read if glob is None else spark.read.option("pathGlobFilter", glob)

    beside = [F.col("_metadata.file_path").alias("_file"), *([_arrived().alias(ARRIVAL)] if arrival else [])]
    added = ["_file", *([ARRIVAL] if arrival else [])]
    lines = reader().text(path).select("value", *beside)
    others = _other_layouts(reader().text(path).select("value", beside[0], F.col("_metadata.file_block_start").alias("_block")))
    text = F.regexp_replace(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")), ",$", "")
    rows = lines.filter(~F.col("_file").isin(others)) if others else lines
    rows = rows.select(text.alias("line"), *added).filter(~F.col("line").isin("[", "]", "[]", ""))
    # To keep what a type cannot hold, every field is read as text first.
    wanted = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]) if rescue else schema
    kept = wanted if _CORRUPT in schema.names else T.StructType([*wanted.fields, T.StructField(_CORRUPT, T.StringType())])
    found = rows.select(F.from_json("line", kept).alias("r"), *added).select("r.*", *added)
    if others:
        whole = spark.read.schema(kept).json(others, multiLine=True)
        found = found.unionByName(whole.select("*", *beside))
    if rescue:
        names = [n for n in schema.names if n != _CORRUPT]
        name = F.url_decode(F.element_at(F.split("_file", "/"), -1))
        lost = _rescued(schema, names, name, F.col(_CORRUPT), NO_RECORD).alias(RESCUED)
        return found.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema], lost, *added)
    if _CORRUPT in schema.names:
        return found
    # Without a column for it, a text that is no record is an error, not a row of nulls.
    empty = F.coalesce(*[F.col(f"`{f.name}`").cast("string") for f in schema]).isNull() if len(schema) else F.lit(True)
    broken = F.raise_error(F.concat(F.lit("not a JSON record in "), F.col("_file"), F.lit(": "), F.col(_CORRUPT)))
    return found.filter(F.when(empty & F.col(_CORRUPT).isNotNull(), broken).isNull()).drop(_CORRUPT)


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool | None = None,
    rescue: bool = False, arrival: bool = False,
) -> DataFrame:
    """JSON records in any layout: one per line, also framed as an array, or arrays laid out otherwise.

    One pass over the lines finds the files that do not have a record per line;
    they are read whole, one task per file, all others split into many tasks.
    ``multi_line=True`` reads every file whole and spares that pass. A record
    that cannot be read is kept as text in ``_corrupt_record`` if the schema has
    that column, otherwise reading fails.

    ``rescue`` keeps what cannot be read in ``_rescued`` instead, as
    :func:`read_csv_records` does: texts that are no record, whole, and values
    that their type cannot hold. Fields are read as texts then, so a number in
    quotes is a number. ``arrival`` adds ``_arrival``. Both need ``multi_line``
    left out.
    """
    if multi_line:
        if rescue or arrival:
            raise ValueError("multi_line=True reads records only")
        return spark.read.schema(schema).json(path, multiLine=True)
    return _json_rows(spark, path, schema, None, rescue, arrival).drop("_file")


def _files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files of a folder grouped by their column names, found by one job over their first lines."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )
    first = lines.filter("_start = 0").withColumn("_row", F.monotonically_increasing_id())
    headers = first.groupBy("_file").agg(F.min_by("value", "_row").alias("header")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(headers, key=lambda r: r["_file"]):
        names = tuple(next(csv.reader([row["header"].lstrip("\ufeff")]), []))
        if names:
            groups.setdefault(names, []).append(row["_file"])
    return groups


def read_inbox(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    exclude: str | None = None,
    multi_line: bool = True,
    rescue: bool = False,
    arrival: bool = False,
) -> DataFrame:
    """All ``*.csv`` and ``*.json`` files of a folder, or of a list of files, by column name.

    Files may have different columns in any order: CSV files with the same
    header are read together, JSON by name and in any layout. ``exclude`` is a file name to skip,
    such as an earlier merge result. Columns of the schema that no file has are
    null; columns it does not name are not read. ``rescue`` and ``arrival`` add
    the columns of :func:`read_csv_records`; without ``rescue`` a text that is
    no JSON record is an error.
    """
    frames = [
        _csv_rows(spark, files, schema, list(names), multi_line, rescue, arrival)
        for names, files in _files_by_header(spark, path).items()
    ]
    json_rows = _json_rows(spark, path, schema, "*.json", rescue, arrival)
    name = F.url_decode(F.element_at(F.split("_file", "/"), -1))
    frames.append(json_rows.withColumn(SOURCE_FILE, name).drop("_file"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if exclude is not None:
        rows = rows.filter(F.col(SOURCE_FILE) != exclude)
    beside = [c for c, asked in ((RESCUED, rescue), (ARRIVAL, arrival)) if asked]
    return rows.select([f.name for f in schema] + [SOURCE_FILE, *beside])


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """Rows of the largest batch id, looked up by one aggregate."""
    newest = df.agg(F.max(batch)).scalar()
    return df.filter(F.col(batch) == newest)


def latest_file(df: DataFrame) -> DataFrame:
    """Rows of the file that sorts last in a frame read from files."""
    return latest_batch(df.withColumn("_batch", F.col(BATCH_FILE)), "_batch").drop("_batch")
