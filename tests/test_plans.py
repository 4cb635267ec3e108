"""Shapes of physical plans that large inputs depend on."""

import contextlib

import pytest
from pyspark.sql import functions as F

import recordloom as rl
from conftest import values
from recordloom.operators.quality import IN_SET, IS_LIST, NON_EMPTY_UNIQUE, NOT_NULL, UNIQUE_PROPORTION
from recordloom.schemas import WORK_SCHEMA


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 1.5,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": 8,
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A master, updates and works as parquet; a third of the rows share a key, a third have none."""
    root = str(tmp_path_factory.mktemp("tables"))
    third = F.col("id") % 3
    base = spark.range(0, 30_000, numPartitions=8)
    records = base.select(
        F.col("id").alias("n"),
        F.when(third == 0, F.lit("10.1000/HOT")).when(third == 1, F.lit("")).otherwise(F.concat(F.lit("10.1000/"), F.col("id"))).alias("doi"),
        F.sha2(F.col("id").cast("string"), 256).alias("title"),
        F.when(third == 0, F.lit(7)).when(third == 2, F.col("id")).alias("k"),
        F.array(F.lit("hot"), F.when(third == 2, F.concat(F.lit("l"), F.col("id"))).otherwise("same")).alias("labels"),
    )
    records.write.parquet(f"{root}/records")
    works = spark.range(0, 30_000, numPartitions=4).select(
        F.concat(F.lit("https://openalex.org/W"), "id").alias("id"),
        F.concat(F.lit("https://doi.org/10.1000/"), F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("doi"),
    )
    rl.conform(works, WORK_SCHEMA).write.parquet(f"{root}/works")
    base.select(F.col("id").alias("k"), F.lit("m").alias("title")).write.parquet(f"{root}/master")
    return {n: f"{root}/{n}" for n in ("records", "works", "master")}


def read(spark, tables, *names):
    return [spark.read.parquet(tables[n]) for n in names]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_and_missing_keys_are_split_in_enrichment(spark, tables):
    records, works = read(spark, tables, "records", "works")
    with conf(spark, **SKEW):
        out = rl.enrich_works(records, works).select("n", "doi", "matched", "title")
        assert "skew=true" in final_plan(out)
        assert out.filter("matched").count() == 20_000
        free = out.filter("doi = ''").groupBy(F.spark_partition_id()).count().count()
        assert free > 1  # rows without a key are as spread as they were


def test_hot_and_missing_keys_are_split_in_inserts(spark, tables):
    records, master = read(spark, tables, "records", "master")
    with conf(spark, **SKEW):
        out = rl.new_rows(master.filter("k > 100"), records.select("k", "n", "title"), "k")
        assert "skew=true" in final_plan(out)
        assert out.filter("k = 7").count() == 10_000
        assert out.filter("k is null").count() == 10_000


def test_repeated_master_key_does_not_pile_up(spark, tables, plan_of):
    (master,) = read(spark, tables, "records")
    updates = spark.createDataFrame([(7, "new", 1)], "k long, title string, o int")
    with conf(spark, **SKEW):
        out = rl.update_master(master.select("k", "n", "title"), updates, "k", ["o"], master_order=["n"])
        assert out.filter("title = 'new'").count() == 1
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 30_000 / 8


def test_hot_label_list_is_split_with_a_large_map(spark, tables):
    (records,) = read(spark, tables, "records")
    label_map = rl.load_label_map(
        spark.createDataFrame(
            [("A", "B", "KEEP", None, None, "Hot"), ("A", "C", "KEEP", None, None, "Same")],
            "`Level I` string, `Level II` string, `Level III` string, `Alevel I` string, `Alevel II` string, `Alevel III` string",
        )
    )
    with conf(spark, **SKEW):
        out = rl.map_labels(records.select("n", "title", "labels"), "labels", label_map, inline_labels=0)
        assert "skew=true" in final_plan(out)
        assert out.filter("size(level3) = 2").count() == 20_000


def test_one_row_per_key_leaves_each_task(spark, tables, plan_of):
    (records,) = read(spark, tables, "records")
    plan = plan_of(rl.last_per_key(records, ["doi"], ["n"]), "simple")
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below and "Partial" in below


def test_label_mapping_moves_no_records(spark, tables, plan_of):
    (records,) = read(spark, tables, "records")
    label_map = rl.load_label_map(
        spark.createDataFrame(
            [("A", "B", "KEEP", None, None, "Hot")],
            "`Level I` string, `Level II` string, `Level III` string, `Alevel I` string, `Alevel II` string, `Alevel III` string",
        )
    )
    plan = plan_of(rl.map_labels(records, "labels", label_map), "simple")
    assert "Exchange" not in plan and "Join" not in plan


def test_row_rules_share_one_scan_of_their_columns(spark, tables, plan_of):
    (records,) = read(spark, tables, "records")
    rules = [rl.Rule(NOT_NULL, "k"), rl.Rule(IN_SET, "doi", {"value_set": ["x"]}), rl.Rule(IS_LIST, "labels"), rl.Rule(NOT_NULL, "doi", row_condition="n > 5")]
    plan = plan_of(rl.run_suite(records, rules, "summary"), "simple")
    assert plan.count("FileScan") == 1
    assert "title" not in plan


def test_unique_rules_of_a_column_share_one_count(spark, tables):
    (records,) = read(spark, tables, "records")
    rules = [rl.Rule(UNIQUE_PROPORTION, "doi", {"min_value": 1}), rl.Rule(NON_EMPTY_UNIQUE, "doi")]
    results = rl.run_suite(records, rules)
    plan = final_plan(results)
    assert "ReusedExchange" in plan
    assert [r["unexpected_count"] for r in results.orderBy("position").collect()] == [9_999 + 9_999, 9_999]


def test_small_updates_leave_the_master_in_place(spark, tables, plan_of):
    (master,) = read(spark, tables, "master")
    updates = spark.createDataFrame([(7, "new", 1)], "k long, title string, o int")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        small = rl.update_master(master, updates, "k", ["o"], broadcast_rows=10)
        scan = [b for b in plan_of(small, "simple").split("BroadcastExchange")[0].splitlines() if "Exchange" in b]
        assert not scan
        large = rl.update_master(master, updates, "k", ["o"], broadcast_rows=0)
        assert "SortMergeJoin" in plan_of(large, "simple")
        assert values(small.filter("title = 'new'")) == values(large.filter("title = 'new'")) == [(7, "new")]


def test_unread_work_fields_are_not_scanned(spark, tables, plan_of):
    records, works = read(spark, tables, "records", "works")
    plan = plan_of(rl.enrich_works(records, works).select("n", "work.id"), "simple")
    assert "abstract_inverted_index" not in plan.split("FileScan")[-1]


def test_filters_of_the_caller_reach_the_scan_through_a_lookup(spark, tables, plan_of):
    records, works, master = read(spark, tables, "records", "works", "master")
    enriched = rl.enrich_works(records, works).filter("n > 29000 AND title <> 'x'")
    assert "GreaterThan(n,29000)" in plan_of(enriched)
    assert values(enriched.select("n"))[0] == (29001,) and enriched.count() == 999
    fresh = rl.new_rows(master, records.select("k", "n", "title"), "k").filter("n < 50")
    assert "LessThan(n,50)" in plan_of(fresh)
    filled = rl.fill_dois(records.withColumnRenamed("title", "url"), spark.createDataFrame([("u", "h")], "url string, html string")).filter("n = 7")
    assert "EqualTo(n,7)" in plan_of(filled) and values(filled, "n") == [(7,)]


def test_only_works_that_are_asked_for_move_with_all_their_fields(spark, tables):
    """Keys are resolved on narrow rows; of the works only those that are found are exchanged wide."""
    records, works = read(spark, tables, "records", "works")
    few = records.filter("n < 60")
    wide = works.withColumn("title", F.concat(F.lit("title of "), "id"))
    out = rl.enrich_works(few, wide).select("n", "matched", "work.title", "work.mesh")
    plan = final_plan(out)
    assert out.filter("matched").count() == 40 and out.count() == 60
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "BroadcastExchange" in line]
    assert moved and "left_semi" in plan.lower().replace("leftsemi", "left_semi")
    scans = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "FileScan" in line and "mesh" in line]
    assert len(scans) == 1


def test_links_and_records_need_no_python(spark, plan_of):
    from catalog.queries import QUERIES

    for name in ("explode_references", "doi_from_pages", "fill_dois", "map_labels", "rebuild_text", "to_record", "upsert_update", "run_suite", "quarantine_rejects"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"), "simple")
        assert "EvalPython" not in plan and "InPandas" not in plan, name
