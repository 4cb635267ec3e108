"""The inbox as a stream of file names: every file is taken once, whatever its layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from ..sources.readers import read_inbox

FORMATS = ("csv", "json")
BATCH = "batch_id"
# Files of one batch at most; their names are all that the driver sees of them.
MAX_FILES = 1000

_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def inbox_files(
    spark: SparkSession, inbox: str, file_formats: tuple[str, ...] = FORMATS, max_files: int = MAX_FILES
) -> DataFrame:
    """Unbounded frame of the files that arrive in a folder, oldest first; their contents are not read."""
    unknown = [f for f in file_formats if f not in FORMATS]
    if unknown or not file_formats:
        raise ValueError(f"unknown inbox formats {unknown}" if unknown else "no inbox format")
    glob = f"*.{file_formats[0]}" if len(file_formats) == 1 else "*.{" + ",".join(file_formats) + "}"
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", max_files).load(inbox).select("path", "modificationTime", "length")


def take_files(
    spark: SparkSession,
    inbox: str,
    checkpoint: str,
    handle: Callable[[list[str], int], None],
    file_formats: tuple[str, ...] = FORMATS,
    max_files: int = MAX_FILES,
) -> None:
    """Hand the files that are new since the last run to ``handle(paths, batch_id)``, batch by batch.

    The stream's checkpoint remembers the files and the batches. A batch that
    failed, or was lost half-way, comes again with the same number and the same
    files, so ``handle`` has to write under that number and replace what it finds.
    """

    def run(files: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in files.select("path").collect()]
        if paths:
            handle(sorted(paths), batch_id)

    stream = inbox_files(spark, inbox, file_formats, max_files).writeStream.foreachBatch(run)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_inbox(
    spark: SparkSession,
    inbox: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    file_formats: tuple[str, ...] = FORMATS,
    max_files: int = MAX_FILES,
    **options,
) -> None:
    """Append every file that is new since the last run to a table of parquet files.

    Each batch groups its files by header and layout, as :func:`read_inbox` does
    (which gets the ``options``), and is a partition ``batch_id`` of the table. A
    batch that comes again replaces its partition, so a failed run leaves one
    copy. What a file holds that cannot be read is kept in ``_rescued``.
    """

    def handle(paths: list[str], batch_id: int) -> None:
        rows = read_inbox(spark, paths, schema, **{"rescue": True, "arrival": True, **options})
        rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")

    take_files(spark, inbox, checkpoint, handle, file_formats, max_files)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of parquet files, or None if nothing has been written to it yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return None


def ingested(spark: SparkSession, table: str) -> DataFrame:
    """Everything taken from the inbox so far, with the number of its batch."""
    found = read_if_there(spark, table)
    if found is None:
        raise ValueError(f"nothing has been taken into {table} yet")
    return found
