"""Writers of records, review rows and validation results, and the publish gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.lists import list_to_text
from ..operators.quality import Rule, WatchedRules, check_suite, suite_passed
from ..session import clear_scratch, scratch_mark, scratch_path

RUN_ID = "run_id"
RUN_TIME = "run_time"


def lists_as_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV has no lists."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    texts = {f.name: list_to_text(f.name) for f in df.schema if isinstance(f.dataType, nested)}
    return df.withColumns(texts) if texts else df


def write_csv_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; quotes are doubled, blanks around texts kept."""
    lists_as_text(df).write.mode(mode).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_json_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON, one record per line."""
    df.write.mode(mode).json(path)


def write_all(df: DataFrame, *writers: Callable[[DataFrame], None]) -> None:
    """Hand the same rows to several writers, computed once: they read a table in the shared folder."""
    spark = df.sparkSession
    mark = scratch_mark(spark)
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    for write in writers:
        write(spark.read.schema(df.schema).parquet(path))
    clear_scratch(spark, mark)


def append_review(review: DataFrame, path: str, run_id: str) -> None:
    """Add the rows for human review as one more run; no rows add no file, a run that comes again replaces its rows."""
    _append_run(review.withColumn(RUN_ID, F.lit(run_id)), path)


def append_rejects(rejects: DataFrame, path: str, run_id: str) -> None:
    """Add the rows a run has set aside, with reasons and what could not be read of them, like :func:`append_review`."""
    _append_run(rejects.withColumn(RUN_ID, F.lit(run_id)), path)


def store_results(
    results: DataFrame, path: str, run_id: str, run_time: dt.datetime | None = None
) -> None:
    """Add the results of a validation run under its run id and time; a run that comes again replaces its results."""
    at = F.current_timestamp() if run_time is None else F.lit(run_time)
    stamped = results.withColumn(RUN_ID, F.lit(run_id)).withColumn(RUN_TIME, at)
    _append_run(stamped, path)


def store_states(states: DataFrame, path: str, run_id: str) -> None:
    """Add the metric states of a batch under its id; a batch that comes again replaces its states."""
    _append_run(states.withColumn(RUN_ID, F.lit(run_id)), path)


def _append_run(df: DataFrame, path: str) -> None:
    # Only the partitions that the rows belong to are written over: those of this run.
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_ID).parquet(path)


def promote_if_valid(
    candidate: DataFrame,
    suite: list[Rule],
    publish: Callable[[DataFrame], None],
    candidate_path: str,
    detail: str = "basic",
    mode: str = "errorifexists",
) -> DataFrame:
    """Write the candidate, check it, and publish it only if every rule passes.

    The candidate stays at ``candidate_path`` either way. Rules on rows are
    counted while it is written; all other checks and publishing read that
    table, so what is published is what was checked.
    """
    watched = WatchedRules(candidate, suite)
    watched.frame.write.mode(mode).parquet(candidate_path)
    return publish_if_valid(candidate.sparkSession.read.parquet(candidate_path), suite, publish, detail, watched)


def publish_if_valid(
    written: DataFrame, suite: list[Rule], publish: Callable[[DataFrame], None], detail: str = "basic", watched: WatchedRules | None = None
) -> DataFrame:
    """Check a table that is written and publish it if every rule passes; the results."""
    results = check_suite(written, suite, detail, watched=watched)
    if suite_passed(results).first()["passed"]:
        publish(written)
    return results
