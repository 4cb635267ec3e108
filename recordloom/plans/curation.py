"""The stages from collected posts to a checked master table, as one run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.identifiers import extract_doi
from ..operators.combine import combine
from ..operators.enrich import enrich_works, fill_dois, record_checks, to_record
from ..operators.quality import Rule
from ..operators.routing import RESCUED, quarantine, route_by_flag
from ..operators.shaping import (
    col_or_default,
    conform,
    drop_missing,
    explode_references,
    incremental_since_month_start,
    source_links,
    with_constants,
    with_post_labels,
)
from ..operators.taxonomy import UNMATCHED, convert_taxonomy, load_label_map
from ..operators.upsert import upsert
from ..schemas import PAPER_SCHEMA, record_schema
from ..session import clear_scratch, scratch_mark
from ..sources.readers import ARRIVAL, read_inbox
from ..sources.sinks import append_rejects, append_review, promote_if_valid, publish_if_valid, store_results
from ..streaming.inbox import BATCH, MAX_FILES, read_if_there, take_files

# Columns a collected paper starts with.
BLANK_FIELDS = {
    "title": "",
    "abstract": "",
    "venue_names": "",
    "full_doc_link": "",
    "is_open_access": "",
    "isBiomimicry": "Y",
}

# Updates up to this many rows are sent to the master instead of moving it.
BROADCAST_ROWS = 20_000

STARTS = ("pull", "convert", "combine", "validate")
CONTENT = "_content"


@dataclass(frozen=True)
class CurationInputs:
    """Frames a run reads.

    ``posts``, ``pages`` and what tells new posts are used by a full run only,
    the label map by a run that converts labels.
    """

    works: DataFrame
    master: DataFrame
    inbox: list[DataFrame] = field(default_factory=list)
    posts: DataFrame | None = None
    pages: DataFrame | None = None
    label_map: DataFrame | None = None
    as_of: dt.datetime | None = None
    post_type: str | None = None


@dataclass(frozen=True)
class CurationRun:
    """Tables of a finished run: ``review`` of one that converts labels, ``rejects`` of one that reads records."""

    candidate: DataFrame
    results: DataFrame
    rejects: DataFrame | None = None
    review: DataFrame | None = None


def collect_papers(posts: DataFrame, as_of: dt.datetime, post_type: str | None) -> DataFrame:
    """One paper per source link of the posts of one type changed this month."""
    changed = incremental_since_month_start(
        posts, "post_modified", as_of, "post_type_label" if post_type is not None else None, post_type
    )
    labels = [f"label_level_{k}" for k in (1, 2, 3)]
    papers = explode_references(with_post_labels(changed), source_links(posts), labels)
    return with_constants(papers, {"doi": "", **BLANK_FIELDS})


def run_curation(
    inputs: CurationInputs,
    workdir: str,
    suite: list[Rule],
    publish: Callable[[DataFrame], None],
    start: str = "pull",
    key: str = "record_id",
    order: tuple[str, ...] = ("url", "doi"),
    broadcast_rows: int = BROADCAST_ROWS,
    stores: str | None = None,
    run_id: str | None = None,
    run_time: dt.datetime | None = None,
    replace: bool = False,
) -> CurationRun:
    """Run all stages, or those from one of them on.

    ``start``: "pull" begins with the posts, "convert" with papers of the inbox
    that still carry source labels, "combine" with papers of the inbox that have
    target labels. "validate" checks the candidate that an earlier run left in
    ``workdir`` and publishes it if it passes now, after a correction by hand.

    Each hand-over that is read more than once (converted papers, enriched
    rows, candidate) is a table below ``workdir``, a new folder that all
    executors reach; with ``replace`` what an earlier attempt of the same run
    left there is written over. Frames from readers that rescue have the rows
    that lost something set aside before anything else. The last of several
    updates of a record is the one that arrived last, if the frames say so
    (``_arrival``), then ``order`` decides; rows that agree on it are told apart
    by their content. Rows without an arrival, those of the posts, come last.

    ``stores`` names a folder with the stores of review rows, rejects and
    results; the run adds to each under its ``run_id``, and replaces what it
    added there before.
    """
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}")
    if stores is not None and run_id is None:
        raise ValueError("a run that adds to stores needs a run_id")
    spark = inputs.works.sparkSession
    mode = "overwrite" if replace else "errorifexists"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode(mode).parquet(f"{workdir}/{name}")
        return spark.read.parquet(f"{workdir}/{name}")

    def finished(results: DataFrame, rejects: DataFrame | None = None, review: DataFrame | None = None) -> CurationRun:
        if stores is not None:
            if review is not None:
                append_review(review, f"{stores}/review", run_id)
            if rejects is not None:
                append_rejects(rejects, f"{stores}/rejects", run_id)
            store_results(results, f"{stores}/results", run_id, run_time)
        return CurationRun(spark.read.parquet(f"{workdir}/candidate"), results, rejects, review)

    if start == "validate":
        return finished(publish_if_valid(spark.read.parquet(f"{workdir}/candidate"), suite, publish))

    review, set_aside, frames = None, [], []
    for df in inputs.inbox:
        if RESCUED in df.columns:
            df, lost = quarantine(df, {})
            set_aside.append(lost)
        frames.append(df)
    if start in ("pull", "convert"):
        if start == "pull":
            papers = fill_dois(collect_papers(inputs.posts, inputs.as_of, inputs.post_type), inputs.pages)
        else:
            papers, frames = combine(frames), []
        converted = convert_taxonomy(papers, load_label_map(inputs.label_map)).drop(UNMATCHED)
        auto, review = route_by_flag(stored(converted, "converted"), "manual_label")
        frames.insert(0, auto)

    usable = drop_missing(combine(frames), "url")
    usable = usable.withColumn("doi", extract_doi(col_or_default(usable, "doi", "")))
    enriched = stored(enrich_works(usable, inputs.works), "enriched")
    good, rejects = quarantine(enriched, record_checks(enriched))
    if set_aside:
        rejects = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rejects, combine(set_aside)])
    arrived = (ARRIVAL,) if ARRIVAL in good.columns else ()
    records = to_record(good, key, arrived)
    content = F.sha2(F.to_json(F.struct(*record_schema(key).names)), 256)
    updates = stored(records.withColumn(CONTENT, content), "records")

    mark = scratch_mark(spark)
    merged = upsert(
        inputs.master, updates, key, [*arrived, *order, CONTENT], broadcast_rows=broadcast_rows
    )
    candidate = conform(merged, record_schema(key))
    results = promote_if_valid(candidate, suite, publish, f"{workdir}/candidate", mode=mode)
    clear_scratch(spark, mark)  # the candidate is written, nothing reads the sorted inserts any more
    return finished(results, rejects, review)


VERSIONS = "versions"


def master_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Number of the batch behind the newest published master, or the newest ``before`` a batch; None if there is none."""
    versions = read_if_there(spark, f"{root}/{VERSIONS}")
    if versions is None:
        return None
    older = versions if before is None else versions.filter(F.col(BATCH) < before)
    return older.agg(F.max(BATCH)).first()[0]


def master_of(spark: SparkSession, root: str, first: DataFrame, before: int | None = None) -> DataFrame:
    """The newest published master below ``root``, ``first`` as long as there is none."""
    version = master_version(spark, root, before)
    return first if version is None else spark.read.parquet(f"{root}/batches/{version}/candidate")


def run_inbox(
    spark: SparkSession,
    inbox: str,
    root: str,
    works: DataFrame,
    master: DataFrame,
    suite: list[Rule],
    label_map: DataFrame | None = None,
    schema: T.StructType = PAPER_SCHEMA,
    max_files: int = MAX_FILES,
    **options,
) -> DataFrame:
    """Take what is new in the inbox through all stages, batch by batch; the newest master that was published.

    The number of a batch is carried through everything it leaves below
    ``root``: what was read (``taken``), its tables and candidate
    (``batches``), its rows in ``review``, ``rejects`` and ``results``, and its
    line in ``versions`` once the candidate has passed. Each batch builds on the
    newest version before it, so a batch that comes again, after a failure or
    by hand, does the same once more and changes nothing else. A candidate that
    fails stays in its folder; later batches go on from the version before it
    until it is corrected and passes :func:`run_curation` from "validate" on.

    With a ``label_map`` papers come with source labels and are converted first.
    ``master`` is what the first batch updates; ``options`` go to :func:`run_curation`.
    """

    def handle(paths: list[str], batch: int) -> None:
        taken = f"{root}/taken/{BATCH}={batch}"
        read_inbox(spark, paths, schema, rescue=True, arrival=True).write.mode("overwrite").parquet(taken)
        base = master_of(spark, root, master, before=batch)

        def publish(_: DataFrame) -> None:
            line = spark.range(1).select(F.lit(batch).cast("long").alias(BATCH))
            line.write.mode("overwrite").parquet(f"{root}/{VERSIONS}/part={batch}")

        run_curation(
            CurationInputs(works, base, [spark.read.parquet(taken)], label_map=label_map),
            f"{root}/batches/{batch}", suite, publish, "combine" if label_map is None else "convert",
            stores=root, run_id=f"batch-{batch}", replace=True, **options,
        )

    take_files(spark, inbox, f"{root}/checkpoint", handle, max_files=max_files)
    return master_of(spark, root, master)
