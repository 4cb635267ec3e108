"""The registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import recordloom as rl
from recordloom.functions.lists import reference_list
from recordloom.operators.quality import (
    COLUMNS_MATCH,
    IN_SET,
    IS_LIST,
    LIST_IN_SET,
    NON_EMPTY_UNIQUE,
    NOT_NULL,
    TYPE_IN_LIST,
    UNIQUE_PROPORTION,
)

from .inputs import (
    PREFIX,
    customer_records,
    doi_pages,
    doi_url,
    joined,
    label_map,
    labelled,
    master,
    page_doi,
    papers,
    part_pages,
    part_posts,
    part_works,
    posts,
    table,
    texts,
    updates,
    works,
)

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Scans, projections, filters --------------------------------------------------

@query
def incremental_since_month_start(spark, sf_dir):
    changed = rl.incremental_since_month_start(
        table(spark, sf_dir, "orders"), "o_orderdate", dt.datetime(2001, 7, 15), "o_orderstatus", "F"
    )
    return changed.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def month_counts(spark, sf_dir):
    month = F.date_format(rl.month_start("o_orderdate"), "yyyy-MM-dd").alias("month")
    return table(spark, sf_dir, "orders").groupBy(month).agg(F.count("*").alias("n_orders"))


@query
def explode_references(spark, sf_dir):
    return rl.explode_references(posts(spark, sf_dir), keep=["page_id"], position="pos")


@query
def with_constants_conform(spark, sf_dir):
    blank = rl.with_constants(
        table(spark, sf_dir, "customer").drop("c_nationkey"),
        {"title": "", "abstract": "", "isBiomimicry": "Y"},
    )
    return rl.conform(blank, ["title", "c_custkey", "isBiomimicry", "abstract", "c_mktsegment"])


@query
def fill_and_drop_missing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = docs.select(
        "doc_id",
        F.when(~((F.col("lang") == "es") & F.col("quality").isNull()), F.col("source")).alias("url"),
        F.when(F.col("quality") == 1, F.col("lang")).alias("good_lang"),
        F.when(F.col("toxic") == 0, F.array("lang", "source")).alias("tags"),
    )
    filled = rl.fill_missing(rl.drop_missing(rows), ["good_lang", "tags"])
    return texts(
        filled.withColumn("verdict", rl.col_or_default(filled, "isBiomimicry", "undetermined"))
        .withColumn("n_tags", F.size("tags"))
    )


@query
def sort_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rl.sort_records(orders, "o_custkey", "o_orderkey", limit=1000)


# Identifiers ------------------------------------------------------------------

@query
def extract_doi(spark, sf_dir):
    text = (
        F.when(F.col("url").contains(".com/"), F.concat(F.lit("see <"), page_doi(), F.lit(">, p. 3")))
        .when(F.col("url").contains(".net/"), F.concat(F.lit("none at "), F.col("url")))
    )
    return table(spark, sf_dir, "pages").select("page_id", rl.extract_doi(text).alias("doi"))


@query
def doi_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", rl.doi_from_url(doi_url()).alias("doi"))


@query
def doi_from_pages(spark, sf_dir):
    return rl.doi_from_pages(doi_pages(spark, sf_dir))


@query
def fill_dois(spark, sf_dir):
    records = table(spark, sf_dir, "pages").select(
        "page_id", doi_url().alias("url"),
        F.when(F.col("url").endswith("/"), F.lit("10.1/own")).otherwise(F.lit("")).alias("doi"),
    )
    pages = doi_pages(spark, sf_dir).select("url", "html")
    return rl.fill_dois(records, pages)


@query
def extract_work_id(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    url = F.when(F.col("lang") == "en", F.concat(F.lit(PREFIX + "W"), key)).when(
        F.col("lang") == "fr", F.concat(F.lit("W"), key)
    )
    return table(spark, sf_dir, "documents").select("doc_id", rl.extract_work_id(url).alias("work_id"))


@query
def to_key(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(k, F.lit(".0")))
        .when(F.col("o_orderstatus") == "O", k).otherwise(F.concat(F.lit("n/a "), k))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", rl.to_key(text).alias("record_id"))


# Lists and text ---------------------------------------------------------------

@query
def path_levels(spark, sf_dir):
    path = F.concat_ws(" > ", "p_type", "p_brand", F.when(F.col("p_size") > 25, F.col("p_name")))
    paths = F.array(path, F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", *[joined(rl.path_level(paths, k)).alias(f"level{k + 1}") for k in range(3)]
    )


@query
def post_labels(spark, sf_dir):
    second = F.concat_ws(" > ", "p_type", "p_brand")
    third = F.concat_ws(" > ", "p_type", "p_brand", "p_name")
    function = F.struct(
        F.array("p_type").alias("lvl0"),
        F.when(F.col("p_size") > 10, F.array(second)).alias("lvl1"),
        F.array(third, third).alias("lvl2"),
    )
    records = table(spark, sf_dir, "part").select(
        "p_partkey", F.struct(function.alias("function")).alias("taxonomies_hierarchical")
    )
    return texts(rl.with_post_labels(records).drop("taxonomies_hierarchical"))


@query
def parse_list_literal(spark, sf_dir):
    text = F.when(
        F.col("p_size") > 5, F.concat(F.lit("['"), F.col("p_type"), F.lit("', \""), F.col("p_name"), F.lit("'s\"]"))
    )
    parsed = rl.parse_list_literal(text)
    return table(spark, sf_dir, "part").select(
        "p_partkey", joined(rl.lower_all(parsed)).alias("labels"), F.size(parsed).alias("n_labels")
    )


@query
def clean_labels(spark, sf_dir):
    labels = F.array(F.col("p_name"), F.concat("p_type", F.lit("\t \n"), "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", joined(rl.clean_labels(labels)).alias("labels"))


@query
def append_missing(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        joined(
            rl.append_missing(
                F.array("p_type", "p_brand"),
                F.array("p_name", "p_brand", "p_name", F.when(F.col("p_size") > 25, F.lit("PROMO")).otherwise("big")),
            )
        ).alias("names"),
    )


@query
def author_lists(spark, sf_dir):
    words = F.split("text", " ")
    authors = F.transform(
        words,
        lambda w: F.struct(
            F.struct(
                F.when(~w.endswith(","), F.concat(F.lit(PREFIX + "A"), w)).alias("id"), w.alias("display_name")
            ).alias("author")
        ),
    )
    ids, names = rl.author_lists("authorships")
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", authors.alias("authorships")
    )
    return texts(rows.select("conv_id", "turn", ids.alias("author_ids"), names.alias("author_names")))


@query
def venue_lists(spark, sf_dir):
    words = F.split("text", " ")
    alternates = F.transform(
        words,
        lambda w: F.struct(
            F.when(~w.endswith(","), F.concat(F.lit(PREFIX + "V"), w)).alias("id"),
            F.when(w.endswith(","), F.lit("")).otherwise(w).alias("display_name"),
        ),
    )
    host = F.struct(F.concat(F.lit(PREFIX), F.col("role")).alias("id"), F.col("role").alias("display_name"))
    ids, names = rl.venue_lists("host", "alternates")
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", host.alias("host"), alternates.alias("alternates")
    )
    return texts(rows.select("conv_id", "turn", ids.alias("venue_ids"), names.alias("venue_names")))


@query
def work_fields(spark, sf_dir):
    """Subject terms, cited works and access fields of each work."""
    flag, link = rl.access_fields("open_access")
    return texts(
        works(spark, sf_dir).select(
            "id", rl.term_names("mesh").alias("mesh_terms"), reference_list("referenced_works").alias("reference_ids"),
            flag.alias("is_open"), link.alias("link"),
        )
    )


@query
def rebuild_text(spark, sf_dir):
    index = F.map_filter(rl.invert_text(F.split("text", " ")), lambda w, p: ~w.endswith(","))
    rows = table(spark, sf_dir, "documents").select("doc_id", index.alias("words"))
    return rows.select(
        "doc_id", rl.rebuild_text("words").alias("text"), rl.max_position("words").alias("last_position")
    )


# Taxonomy ---------------------------------------------------------------------

@query
def load_label_map(spark, sf_dir):
    return rl.load_label_map(label_map(spark, sf_dir))


@query
def load_label_map_filled(spark, sf_dir):
    rows = label_map(spark, sf_dir).withColumn("nth", F.col("Alevel III"))
    return rl.load_label_map(rows, forward_fill=True, order="nth")


@query
def map_labels(spark, sf_dir):
    rows = labelled(spark, sf_dir, "l_orderkey")
    mapped = rl.map_labels(rows, "label_level_3", rl.load_label_map(label_map(spark, sf_dir)))
    return texts(mapped.drop("label_level_3"))


@query
def map_labels_large_map(spark, sf_dir):
    rows = labelled(spark, sf_dir, "l_orderkey")
    mapped = rl.map_labels(
        rows, "label_level_3", rl.load_label_map(label_map(spark, sf_dir)), inline_labels=0
    )
    return texts(mapped.drop("label_level_3"))


def _converted(spark, sf_dir) -> DataFrame:
    return rl.convert_taxonomy(
        labelled(spark, sf_dir, "l_orderkey"), rl.load_label_map(label_map(spark, sf_dir))
    )


@query
def convert_taxonomy(spark, sf_dir):
    return texts(_converted(spark, sf_dir))


@query
def route_auto(spark, sf_dir):
    return texts(rl.route_by_flag(_converted(spark, sf_dir), "manual_label")[0])


@query
def route_review(spark, sf_dir):
    return texts(rl.route_by_flag(_converted(spark, sf_dir), "manual_label")[1])


# Union, keys, upsert ------------------------------------------------------------

@query
def combine(spark, sf_dir):
    return rl.combine(
        [
            table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("party"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
            ),
            table(spark, sf_dir, "supplier").select(
                F.col("s_name").alias("name"), F.col("s_suppkey").alias("party"), F.col("s_acctbal").alias("balance")
            ),
            table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand")),
        ]
    )


_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query
def first_per_key(spark, sf_dir):
    rows = rl.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE)
    return rows.select(*_LINE_OUT)


@query
def last_per_key(spark, sf_dir):
    rows = rl.last_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE)
    return rows.select(*_LINE_OUT)


@query
def assign_sequential_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    start = rl.next_key(orders, "o_orderkey")
    numbered = rl.assign_sequential_ids(orders, "record_id", start, ["o_orderdate", "o_orderkey"])
    return numbered.drop("o_orderdate")


@query
def upsert_update(spark, sf_dir):
    return rl.update_master(master(spark, sf_dir), updates(spark, sf_dir), "record_id", ["seq"])


@query
def upsert_keep_old(spark, sf_dir):
    return rl.update_master(
        master(spark, sf_dir), updates(spark, sf_dir), "record_id", ["seq"],
        keep_old_if_null=True, broadcast_rows=100_000,
    )


@query
def upsert_repeated_master(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("record_id"), "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    new = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("record_id"), F.col("c_acctbal").alias("o_totalprice"),
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("seq"),
    )
    return rl.update_master(orders, new, "record_id", ["seq"], master_order=["o_orderkey"])


@query
def upsert_insert(spark, sf_dir):
    return rl.new_rows(master(spark, sf_dir), updates(spark, sf_dir), "record_id")


@query
def upsert(spark, sf_dir):
    return rl.upsert(master(spark, sf_dir), updates(spark, sf_dir), "record_id", ["seq"])


# Enrichment -------------------------------------------------------------------

@query
def merge_ranges(spark, sf_dir):
    """The same merge into a table in ranges of the key, of which only those with updates are written anew."""
    path = rl.scratch_path(spark, "ranges")
    rl.create_master(master(spark, sf_dir), path, "record_id", width=100)
    rl.merge_master(spark, path, updates(spark, sf_dir), "record_id", ["seq"])
    return rl.read_master(spark, path)


@query
def enrich_works(spark, sf_dir):
    rows = rl.enrich_works(papers(spark, sf_dir), works(spark, sf_dir))
    return rows.select("doc_id", "matched", F.col("work.id").alias("work_id"), "doi", F.col("work.title").alias("title"))


@query
def enrich_without_doi(spark, sf_dir):
    rows = rl.enrich_works(papers(spark, sf_dir), works(spark, sf_dir), require_doi=False)
    return rows.select("doc_id", "matched", F.col("work.id").alias("work_id"), "doi")


@query
def to_record(spark, sf_dir):
    return texts(rl.to_record(rl.enrich_works(papers(spark, sf_dir), works(spark, sf_dir))))


# Quality ----------------------------------------------------------------------

def _shown(results: DataFrame) -> DataFrame:
    out = results.withColumn("unexpected_percent", F.round("unexpected_percent", 6)).drop("position", "error")
    return texts(out)


def _labelled_docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query
def rule_not_null(spark, sf_dir):
    rules = [rl.Rule(NOT_NULL, "quality"), rl.Rule(NOT_NULL, "text")]
    return _shown(rl.run_suite(_labelled_docs(spark, sf_dir), rules))


@query
def rule_in_set(spark, sf_dir):
    rules = [
        rl.Rule(IN_SET, "o_orderpriority", {"value_set": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}),
        rl.Rule(IN_SET, "o_orderstatus", {"value_set": ["F", "O", "P"]}),
    ]
    return _shown(rl.run_suite(table(spark, sf_dir, "orders"), rules))


@query
def rule_unique_proportion(spark, sf_dir):
    rules = [
        rl.Rule(UNIQUE_PROPORTION, "l_orderkey", {"min_value": 0.1, "max_value": 0.5}),
        rl.Rule(UNIQUE_PROPORTION, "l_orderkey", {"min_value": 1, "max_value": 1}),
    ]
    return _shown(rl.run_suite(table(spark, sf_dir, "lineitem"), rules))


@query
def rule_non_empty_unique(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # Every text, and further rows without one.
    none = F.when(F.col("lang") == "de", F.lit(""))
    rows = docs.select("doc_id", "text").union(docs.filter(F.col("lang").isin("de", "es")).select("doc_id", none.alias("text")))
    rules = [rl.Rule(NON_EMPTY_UNIQUE, "text"), rl.Rule(NON_EMPTY_UNIQUE, "doc_id"), rl.Rule(NON_EMPTY_UNIQUE, "text", mostly=0.5)]
    return _shown(rl.run_suite(rows, rules, "summary"))


@query
def rule_list_in_set(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("words"))
    allowed = ["red", "blue", "small", "ring", "rod", "anvil", "bolt", "gear", "plate", "gizmo", "widget"]
    return _shown(rl.run_suite(words, [rl.Rule(LIST_IN_SET, "words", {"value_set": allowed})]))


@query
def rule_is_list(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("label") > 2, F.col("embedding")).alias("some")
    )
    rules = [rl.Rule(IS_LIST, "embedding"), rl.Rule(IS_LIST, "some"), rl.Rule(IS_LIST, "vec_id")]
    return _shown(rl.run_suite(vectors, rules, "summary"))


@query
def rule_schema(spark, sf_dir):
    rules = [
        rl.Rule(COLUMNS_MATCH, params={"column_list": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]}),
        rl.Rule(COLUMNS_MATCH, params={"column_list": ["o_custkey", "o_orderkey"]}),
        rl.Rule(TYPE_IN_LIST, "o_orderkey", {"type_list": ["IntegerType", "LongType"]}),
        rl.Rule(TYPE_IN_LIST, "o_totalprice", {"type_list": ["StringType", "string"]}),
        rl.Rule(NOT_NULL, "o_orderkey"),
    ]
    return _shown(rl.run_suite(table(spark, sf_dir, "orders"), rules, "summary"))


@query
def rule_mostly_and_condition(spark, sf_dir):
    flags = {"value_set": ["A", "R"]}
    rules = [
        rl.Rule(IN_SET, "l_returnflag", flags, mostly=0.5),
        rl.Rule(IN_SET, "l_returnflag", flags, mostly=0.9),
        rl.Rule(IN_SET, "l_returnflag", flags, row_condition="l_linestatus = 'F'"),
        rl.Rule(IN_SET, "l_returnflag", flags, row_condition="l_quantity < 0"),
        rl.Rule(NON_EMPTY_UNIQUE, "l_orderkey", mostly=0.1, row_condition="l_linenumber = 1"),
    ]
    return _shown(rl.run_suite(table(spark, sf_dir, "lineitem"), rules, "summary"))


rl.register_aggregate_rule(
    "expect_column_mean_to_be_between",
    lambda c, p: {"total": F.sum(c.cast("decimal(18,2)")), "n": F.count(c)},
    lambda s, p: F.try_divide(s["total"], s["n"]).between(F.lit(p["min_value"]), F.lit(p["max_value"])),
)
rl.register_keyed_rule("expect_values_to_occur_at_most", lambda value, times, p: times > p["times"])


@query
def aggregate_rules(spark, sf_dir):
    """Rules on a column as a whole and on how often its values occur, beside rules on rows and uniqueness."""
    mean, often = "expect_column_mean_to_be_between", "expect_values_to_occur_at_most"
    suite = [
        rl.Rule(mean, "o_totalprice", {"min_value": 0, "max_value": 1_000_000_000}),
        rl.Rule(mean, "o_totalprice", {"min_value": 0, "max_value": 1}, row_condition="o_orderstatus = 'F'"),
        rl.Rule(often, "o_custkey", {"times": 12}, mostly=0.5),
        rl.Rule(NON_EMPTY_UNIQUE, "o_custkey"),
        rl.Rule(NOT_NULL, "o_totalprice"),
    ]
    return _shown(rl.run_suite(table(spark, sf_dir, "orders"), suite, "summary"))


@query
def unexpected_keys(spark, sf_dir):
    """Customers with more than twelve orders, and how many each has."""
    return rl.unexpected_values(table(spark, sf_dir, "orders"), rl.Rule("expect_values_to_occur_at_most", "o_custkey", {"times": 12}))


_STATE_SUITE = [
    rl.Rule(NOT_NULL, "o_orderkey"),
    rl.Rule(IN_SET, "o_orderpriority", {"value_set": ["1-URGENT", "5-LOW"]}, mostly=0.1),
    rl.Rule(IN_SET, "o_orderstatus", {"value_set": ["F"]}),
    rl.Rule(UNIQUE_PROPORTION, "o_orderkey", {"min_value": 0.8}),
    rl.Rule(NON_EMPTY_UNIQUE, "o_custkey"),
]


@query
def metric_states(spark, sf_dir):
    """Orders appended in batches by status, each read once; the results of the table from what was kept of them."""
    path, orders = rl.scratch_path(spark, "states"), table(spark, sf_dir, "orders")
    for status in ("F", "O", "P", "F"):
        batch = orders.filter(F.col("o_orderstatus") == status)
        rl.store_states(rl.metric_states(batch, _STATE_SUITE), path, f"status-{status}")
    results = rl.merged_results(spark.read.parquet(path), _STATE_SUITE)
    exact = F.when(F.col("error_bound") == 0, F.col("unexpected_count"))
    return results.select("rule", "column", "element_count", "missing_count", exact.alias("unexpected_count"), "success")


@query
def unexpected_rows(spark, sf_dir):
    rl.register_rule("expect_positive_discount", lambda c, p: c <= p.get("above", 0))
    rows = rl.unexpected_rows(
        table(spark, sf_dir, "lineitem"),
        rl.Rule("expect_positive_discount", "l_discount", row_condition="l_linestatus = 'O'"),
    )
    return rows.select(*_LINE_OUT)


@query
def unexpected_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rl.unexpected_rows(docs, rl.Rule(NON_EMPTY_UNIQUE, "text"), ["doc_id"])


@query
def unexpected_values(spark, sf_dir):
    return rl.unexpected_values(table(spark, sf_dir, "lineitem"), rl.Rule(UNIQUE_PROPORTION, "l_partkey"))


SUITE = json.dumps(
    {
        "expectations": [
            {"expectation_type": NOT_NULL, "kwargs": {"column": "o_orderkey"}},
            {"expectation_type": UNIQUE_PROPORTION, "kwargs": {"column": "o_orderkey", "min_value": 1, "max_value": 1}},
            {"expectation_type": IN_SET, "kwargs": {"column": "o_orderstatus", "value_set": ["F", "O"], "mostly": 0.6}},
            {"expectation_type": IN_SET, "kwargs": {"column": "o_orderpriority", "value_set": ["5-LOW"]}},
            {"expectation_type": NON_EMPTY_UNIQUE, "kwargs": {"column": "o_custkey"}},
            {"expectation_type": NOT_NULL, "kwargs": {"column": "no_such_column"}},
            {"expectation_type": LIST_IN_SET, "kwargs": {"column": "o_orderstatus", "value_set": ["F"]}},
        ]
    }
)


@query
def run_suite(spark, sf_dir):
    results = rl.run_suite(table(spark, sf_dir, "orders"), rl.suite_from_json(SUITE))
    broken = F.col("error").isNotNull().alias("broken")
    return _shown(results.withColumn("broken", broken))


@query
def bad_values(spark, sf_dir):
    """All bad values of the suite's rules, as a table."""
    return rl.bad_values(table(spark, sf_dir, "orders"), rl.suite_from_json(SUITE))


@query
def suite_verdict(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    suite = rl.suite_from_json(SUITE)
    all_rules = rl.suite_passed(rl.run_suite(orders, suite, "summary"))
    sound = rl.suite_passed(rl.run_suite(orders, suite[:3], "summary"))
    return rl.combine(
        [all_rules.select(F.lit("all").alias("suite"), "passed"), sound.select(F.lit("first three").alias("suite"), "passed")]
    )


@query
def check_suite(spark, sf_dir):
    """Results of a suite with a rule that cannot run, evaluated at once."""
    suite = [
        rl.Rule(NOT_NULL, "o_orderkey"),
        rl.Rule("expect_something_unknown", "o_orderpriority"),
        rl.Rule(IN_SET, "o_orderstatus", {"value_set": ["F", "O"]}, mostly=0.6),
    ]
    results = rl.check_suite(table(spark, sf_dir, "orders"), suite, "summary")
    return _shown(results.withColumn("broken", F.col("error").isNotNull()))


@query
def promote_if_valid(spark, sf_dir):
    """Two candidates: the one that passes is published, the other is not."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    published = rl.scratch_path(spark, "published")
    suite = rl.suite_from_json(SUITE)
    for name, rules in (("good", suite[:3]), ("bad", suite)):
        candidate = orders.withColumn("candidate", F.lit(name))
        rl.promote_if_valid(
            candidate, rules, lambda df: df.write.mode("append").parquet(published),
            rl.scratch_path(spark, "candidate"), "summary",
        )
    return spark.read.parquet(published)


# Row errors -------------------------------------------------------------------

def _checked_events(spark, sf_dir):
    """Events with some broken keys, properties and texts of lists."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.concat(F.lit("u"), user)).otherwise(user).alias("user_key"),
        F.when(F.col("value") > 300, F.concat(F.lit("<"), F.col("props"))).otherwise(F.col("props")).alias("props"),
    )
    parsed = F.from_json("props", "k int")
    checks = {
        "key is not a number": rl.to_key("user_key").isNull(),
        "props are not json": parsed["k"].isNull(),
    }
    return rl.quarantine(rows, checks)


@query
def quarantine_good(spark, sf_dir):
    good, _ = _checked_events(spark, sf_dir)
    return good.select("event_id", rl.to_key("user_key").alias("user_id"), F.from_json("props", "k int")["k"].alias("k"))


@query
def quarantine_rejects(spark, sf_dir):
    return _checked_events(spark, sf_dir)[1]


# Files ------------------------------------------------------------------------

@query
def latest_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return rl.latest_batch(events, "day").select("event_id", "user_id", "event_type", "day")


def _docs_to_write(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") != "es", F.col("lang")).alias("note"), F.array("lang", "source").alias("tags"), "n_chars"
    )


_DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("n_chars", T.LongType()),
    ]
)


@query
def csv_round_trip(spark, sf_dir):
    path = rl.scratch_path(spark, "csv")
    rl.write_csv_records(_docs_to_write(spark, sf_dir), path)
    return texts(rl.read_csv_records(spark, path, _DOC_SCHEMA))


@query
def json_round_trip(spark, sf_dir):
    path = rl.scratch_path(spark, "json")
    rl.write_json_records(_docs_to_write(spark, sf_dir), path)
    return texts(rl.read_json_records(spark, path, _DOC_SCHEMA))


@query
def write_all(spark, sf_dir):
    """The same documents in two formats, written from one computation."""
    as_csv, as_json = rl.scratch_path(spark, "csv"), rl.scratch_path(spark, "json")
    rl.write_all(
        _docs_to_write(spark, sf_dir),
        lambda df: rl.write_csv_records(df, as_csv),
        lambda df: rl.write_json_records(df, as_json),
    )
    copies = [
        rl.read_csv_records(spark, as_csv, _DOC_SCHEMA).withColumn("copy", F.lit("csv")),
        rl.read_json_records(spark, as_json, _DOC_SCHEMA).withColumn("copy", F.lit("json")),
    ]
    return texts(rl.combine(copies))


_PARTY_SCHEMA = T.StructType(
    [
        T.StructField("party", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("balance", T.DoubleType()),
    ]
)


@query
def read_inbox(spark, sf_dir):
    """Customers and suppliers as CSV files with other columns, parts as JSON."""
    inbox = rl.scratch_path(spark, "inbox")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("party"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("party"))
    rl.write_csv_records(customers, inbox, "append")
    rl.write_csv_records(suppliers, inbox, "append")
    rl.write_json_records(parts, inbox, "append")
    return rl.read_inbox(spark, inbox, _PARTY_SCHEMA).drop("source_file")


_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query
def ingest_inbox(spark, sf_dir):
    """Two runs of the stream: the second takes only what came after the first."""
    inbox, out, state = (rl.scratch_path(spark, n) for n in ("inbox", "table", "state"))
    events = table(spark, sf_dir, "events").select([f.name for f in _EVENT_SCHEMA])
    early, late = F.col("event_type") != "error", F.col("event_type") == "error"
    rl.write_csv_records(events.filter(early), inbox, "append")
    rl.ingest_inbox(spark, inbox, out, state, _EVENT_SCHEMA, ("csv",))
    rl.write_csv_records(events.filter(late), inbox, "append")
    rl.ingest_inbox(spark, inbox, out, state, _EVENT_SCHEMA, ("csv",))
    return rl.ingested(spark, out).select([f.name for f in _EVENT_SCHEMA])


_LONG, _TEXT, _DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
_TEXTS = T.ArrayType(_TEXT)


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_LOSSY_SCHEMA = _fields(("key", _LONG), ("price", _DOUBLE), ("tags", _TEXTS), ("note", _TEXT))


def _lossy_inbox(spark, sf_dir) -> str:
    """Orders as CSV lines, customers as JSON lines; some with values that are not of their type, or too many fields."""
    inbox = rl.scratch_path(spark, "inbox")
    price, kind = F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.substring("o_orderpriority", 1, 1)
    fields = [
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("<"), price)).otherwise(price),
        F.when(kind == "1", F.lit("['open")).when(kind == "2", F.lit("['a'; 'b']")).otherwise(F.lit("['a']")),
        F.when(F.col("o_orderstatus") == "P", F.lit("more,fields")).otherwise(F.lit("one")),
    ]
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(",", *fields).alias("key,price,tags,note"))
    lines.write.csv(inbox, header=True, sep="\x01", quote="\x00")
    debt, name = F.col("c_acctbal") < 0, F.col("c_mktsegment")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.when(debt, F.lit("debt")).otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(name == "BUILDING", name).otherwise(F.lit("['b']")).alias("tags"),
    )
    rl.write_json_records(customers, inbox, "append")
    return inbox


@query
def rescued_good(spark, sf_dir):
    """Rows of an inbox that lost nothing when they were read."""
    good, _ = rl.quarantine(rl.read_inbox(spark, _lossy_inbox(spark, sf_dir), _LOSSY_SCHEMA, rescue=True), {})
    return texts(good.drop("source_file"))


@query
def rescued_rejects(spark, sf_dir):
    """What was lost of the others, entry by entry, with the kind of file it stood in."""
    _, rejects = rl.quarantine(rl.read_inbox(spark, _lossy_inbox(spark, sf_dir), _LOSSY_SCHEMA, rescue=True), {})
    return rejects.select("key", "error_reason", F.inline("_rescued")).select(
        "key", "error_reason", "field", "raw", "reason", F.element_at(F.split("file", "\\."), -1).alias("kind")
    )


@query
def ingest_layouts(spark, sf_dir):
    """Two runs of the stream over CSV files with two headers and JSON in two layouts."""
    inbox, out, state = (rl.scratch_path(spark, n) for n in ("inbox", "table", "state"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("party"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("party"))
    rl.write_csv_records(customers, inbox, "append")
    rl.write_json_records(parts, inbox, "append")
    rl.ingest_inbox(spark, inbox, out, state, _PARTY_SCHEMA)
    rl.write_csv_records(suppliers, inbox, "append")
    # The nations as records of several lines, a file each: there are always as many.
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("party"), F.col("n_name").alias("name"))
    nations.write.mode("append").option("pretty", "true").option("maxRecordsPerFile", 1).json(inbox)
    rl.ingest_inbox(spark, inbox, out, state, _PARTY_SCHEMA)
    return rl.ingested(spark, out).select([f.name for f in _PARTY_SCHEMA])


_ORDER_SCHEMA = _fields(("o_custkey", _LONG), ("o_orderkey", _LONG), ("o_orderpriority", _TEXT))


@query
def arrival_order(spark, sf_dir):
    """The order of each customer that arrived last: files of their last orders, then of their first that is not urgent."""
    inbox = rl.scratch_path(spark, "inbox")
    orders = table(spark, sf_dir, "orders").select(_ORDER_SCHEMA.names)
    calm = orders.filter(~F.col("o_orderpriority").startswith("1"))
    rl.write_csv_records(rl.last_per_key(orders, ["o_custkey"], ["o_orderkey"]), inbox, "append")
    rl.write_csv_records(rl.first_per_key(calm, ["o_custkey"], ["o_orderkey"]), inbox, "append")
    rows = rl.read_csv_records(spark, inbox, _ORDER_SCHEMA, arrival=True)
    return rl.last_per_key(rows, ["o_custkey"], ["_arrival"]).drop("_arrival")


@query
def results_store(spark, sf_dir):
    path = rl.scratch_path(spark, "results")
    orders, suite = table(spark, sf_dir, "orders"), rl.suite_from_json(SUITE)
    at = dt.datetime(2024, 1, 1)
    rl.store_results(rl.run_suite(orders, suite, "summary"), path, "run-1", at)
    rl.store_results(rl.run_suite(orders, suite[:3], "summary"), path, "run-2", at)
    return spark.read.parquet(path).select("run_id", "rule", "column", "unexpected_count", "success")


@query
def append_review(spark, sf_dir):
    path = rl.scratch_path(spark, "review")
    _, review = rl.route_by_flag(_converted(spark, sf_dir), "manual_label")
    for run in ("run-1", "run-2"):
        rl.append_review(review.select("l_orderkey"), path, run)
    return spark.read.parquet(path)


# Whole runs -------------------------------------------------------------------

RUN_SUITE = [
    rl.Rule(NOT_NULL, "record_id"),
    rl.Rule(UNIQUE_PROPORTION, "record_id", {"min_value": 1, "max_value": 1}),
    rl.Rule(NOT_NULL, "url"),
    rl.Rule(IN_SET, "isBiomimicry", {"value_set": ["N", "Y", "undetermined"]}),
    rl.Rule(IS_LIST, "level1"),
    rl.Rule(NON_EMPTY_UNIQUE, "url"),
]


def _inbox_papers(spark, sf_dir) -> DataFrame:
    """Documents as papers; those of ``src4`` have a broken list."""
    broken = F.when(F.col("title") == "src4", F.lit("['open")).otherwise(F.lit(""))
    return papers(spark, sf_dir).withColumn("label_level_3", broken)


def _merge_run(spark, sf_dir, publish=lambda df: None) -> rl.CurationRun:
    """Documents merged into customers."""
    inputs = rl.CurationInputs(works(spark, sf_dir), customer_records(spark, sf_dir), [_inbox_papers(spark, sf_dir)])
    return rl.run_curation(inputs, rl.scratch_path(spark, "run"), RUN_SUITE, publish, start="combine")


@query
def curation_merge(spark, sf_dir):
    return texts(_merge_run(spark, sf_dir).candidate)


@query
def curation_rejects(spark, sf_dir):
    return _merge_run(spark, sf_dir).rejects.select("doc_id", "error_reason")


@query
def curation_results(spark, sf_dir):
    return _merge_run(spark, sf_dir).results.select("rule", "column", "element_count", "unexpected_count", "success")


_INBOX_PAPER = _fields(
    ("doc_id", _LONG), ("record_id", _LONG), ("paper", _TEXT), ("doi", _TEXT), ("url", _TEXT), ("title", _TEXT), ("label_level_1", _TEXTS),
    ("label_level_2", _TEXTS), ("label_level_3", _TEXTS), ("venue_names", _TEXT), ("absolute_relevancy", T.ArrayType(_DOUBLE)),
)


def _inbox_run(spark, sf_dir) -> tuple[DataFrame, str]:
    """Documents that arrive in an inbox, in CSV files of two headers, then as JSON; the last run finds nothing new."""
    inbox, root = rl.scratch_path(spark, "inbox"), rl.scratch_path(spark, "root")
    papers_in = _inbox_papers(spark, sf_dir)
    names = _INBOX_PAPER.names
    first, second = F.col("venue_names").contains("'en'"), F.col("venue_names") == "Plain Venue"
    rl.write_csv_records(papers_in.filter(first).select(names), inbox, "append")
    rl.write_csv_records(papers_in.filter(second).select(names[::-1]), inbox, "append")

    def run() -> DataFrame:
        return rl.run_inbox(
            spark, inbox, root, works(spark, sf_dir), customer_records(spark, sf_dir), RUN_SUITE, schema=_INBOX_PAPER
        )

    run()
    rl.write_json_records(papers_in.filter(~first & ~second).select(names), inbox, "append")
    run()
    return run(), root


@query
def inbox_run(spark, sf_dir):
    """The master after all batches; new records are numbered as they arrive, so their keys are left out."""
    newest, _ = _inbox_run(spark, sf_dir)
    shown = ["paper", "url", "doi", "title", "level1", "level2", "level3", "venue_ids", "venue_names", "absolute_relevancy"]
    return texts(newest.select(*shown))


@query
def inbox_run_stores(spark, sf_dir):
    """What the batches left in the stores of rejects and results."""
    _, root = _inbox_run(spark, sf_dir)
    rejects = spark.read.parquet(f"{root}/rejects").groupBy(F.substring_index("run_id", "-", -1).cast("int").alias("batch"), F.col("error_reason").alias("what"))
    results = spark.read.parquet(f"{root}/results").groupBy(F.substring_index("run_id", "-", -1).cast("int").alias("batch"), F.col("rule").alias("what"))
    return rejects.agg(F.count("*").alias("n")).unionByName(results.agg(F.max("element_count").alias("n")))


def _full_run(spark, sf_dir, publish=lambda df: None) -> rl.CurationRun:
    """Parts as posts, taken through every stage into customers."""
    inputs = rl.CurationInputs(
        works=part_works(spark, sf_dir),
        master=customer_records(spark, sf_dir),
        posts=part_posts(spark, sf_dir),
        pages=part_pages(spark, sf_dir),
        label_map=label_map(spark, sf_dir),
        as_of=dt.datetime(2024, 1, 20),
        post_type="Strategies",
    )
    return rl.run_curation(inputs, rl.scratch_path(spark, "run"), RUN_SUITE, publish)


@query
def curation_full(spark, sf_dir):
    """What the gate lets through of a full run."""
    published = rl.scratch_path(spark, "published")
    _full_run(spark, sf_dir, lambda df: df.write.parquet(published))
    return texts(spark.read.parquet(published))


@query
def curation_review(spark, sf_dir):
    return texts(_full_run(spark, sf_dir).review)
