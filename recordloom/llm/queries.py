"""Queries over the test tables: one per operator, each on its whole table."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.bpe import bpe_round_trip
from recordloom.llm.collocations import PHRASES_SQL, collocations
from recordloom.llm.common import table
from recordloom.llm.conversation_repair import REPAIR_SQL, repair_reports
from recordloom.llm.decontamination import HITS_SQL, decontaminated
from recordloom.llm.mixing import MIX_SQL, mixed
from recordloom.llm.near_dup import near_duplicates
from recordloom.llm.pivots import near_vectors
from recordloom.llm.preference import PAIRS_SQL, answered, preference_pairs
from recordloom.llm.repetition import repetition_rules
from recordloom.llm.scoring import corpus_scores
from recordloom.llm.sharding import assign_shards
from recordloom.llm.spans import without_repeated_spans
from recordloom.llm.toxicity import CATEGORIES, flagged

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_scores(table(spark, sf_dir, "documents"))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


def op3_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(answered(table(spark, sf_dir, "conversations")))


def op4_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("k1", "k2", "group")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(CATEGORIES)], "toxic")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixed(table(spark, sf_dir, "documents"))
    listed = [F.array_join(F.col("draws")[n].cast("array<string>"), ",").alias(f"{n}s") for n in ("shard", "block")]
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), *listed)


def op10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_spans(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), named, (F.col("n_hit") > 0).alias("contaminated")
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_reports(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_scoring": op1_scoring,
    "op2_repetition": op2_repetition,
    "op3_preference": op3_preference,
    "op4_pivots": op4_pivots,
    "op5_bpe": op5_bpe,
    "op6_minhash": op6_minhash,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_spans": op10_spans,
    "op11_decontamination": op11_decontamination,
    "op12_repair": op12_repair,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op3_preference": PAIRS_SQL,
    "op9_mixing": MIX_SQL,
    "op11_decontamination": HITS_SQL,
    "op12_repair": REPAIR_SQL,
    "op13_collocations": PHRASES_SQL,
}
