"""A training corpus from raw documents, stage by stage.

Each stage works on all that the stage before has kept; its rows are written as
Parquet to the shared folder and read again, so a lost executor costs no more
than the stage it was busy with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.bpe import bpe_round_trip
from recordloom.llm.common import table
from recordloom.llm.mixing import mixture
from recordloom.llm.near_dup import one_of_each
from recordloom.llm.queries import RANKS
from recordloom.llm.spans import without_repeated_spans
from recordloom.llm.toxicity import without_toxic
from recordloom.session import clear_scratch, scratch_mark, scratch_path

# Documents with so many of their five-word shingles in common are near duplicates.
SIMILAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; documents without words stay."""
    return one_of_each(docs, percent=SIMILAR_PERCENT)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each passage in one of them only; ``n_chars`` follows the text."""
    got = without_repeated_spans(docs).select(*docs.columns)
    return got.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else got


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, block by block in shuffled order."""
    return mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    return bpe_round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_spans),
    ("mixing", mix),
    ("bpe", encode),
]

# SQL has neither the classifiers nor the merges; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = scratch_mark(spark)
        done, path = stage(spark, docs, sf_dir), scratch_path(spark, name)
        done.write.parquet(path)
        # What the stage has stored on its way is read by nothing else.
        clear_scratch(spark, mark, keep=(path,))
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
