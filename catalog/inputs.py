"""Inputs of the registered queries, derived from whole test tables.

The tables hold no DOIs, label paths or works, so these are built from what
they do hold. Every variety (missing values, repeats, misses) follows from the
content of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import recordloom as rl
from recordloom.schemas import RECORD_SCHEMA

PREFIX = "https://openalex.org/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(c: Column | str) -> Column:
    """A list as text, so that results compare as plain values."""
    return F.array_join(c, "|")


def texts(df: DataFrame) -> DataFrame:
    """Every list column as text."""
    lists = {f.name: joined(f.name) for f in df.schema if f.dataType.typeName() == "array"}
    return df.withColumns(lists) if lists else df


# Pages ----------------------------------------------------------------------

def page_host() -> Column:
    return F.regexp_extract("url", "//([^/]+)", 1)


def page_doi() -> Column:
    return F.concat(F.lit("10.5555/"), page_host(), F.lit("."), F.col("page_id").cast("string"))


def doi_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a DOI link (.com), one without a path (.net) or none (.org)."""
    own = F.concat(F.lit('<a href="https://doi.org/'), F.regexp_replace(page_doi(), "/", "%"), F.lit('">x</a>'))
    first = (
        F.when(F.col("url").contains(".com/"), own)
        .when(F.col("url").contains(".net/"), F.lit('<a href="https://doi.org">x</a>'))
        .otherwise(F.lit(""))
    )
    last = F.when(F.col("url").contains(".com/"), F.lit('<a href="https://doi.org/10.1/late">y</a>')).otherwise(F.lit(""))
    html = F.concat(F.regexp_replace("html", "<article>", ""), first, last)
    return table(spark, sf_dir, "pages").select("page_id", doi_url().alias("url"), html.alias("html"))


def doi_url() -> Column:
    """The url, with a DOI in it where it has a query."""
    return F.when(
        F.col("url").contains("?"), F.concat("url", F.lit("/doi/"), page_doi(), F.lit("&v=1"))
    ).otherwise(F.col("url"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as posts: links in one of two source objects."""
    links = rl.page_links("html")
    none = F.array().cast("array<string>")
    reference = (
        F.when(F.col("url").contains("?"), F.lit(None))
        .when(F.col("url").endswith("/"), F.struct(none.alias("source_link")))
        .otherwise(F.struct(links.alias("source_link")))
    )
    other = F.struct(F.array("url").alias("source_link"))
    return table(spark, sf_dir, "pages").select(
        "page_id", reference.alias("reference_sources"), other.alias("sources")
    )


# Labels ---------------------------------------------------------------------

def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map with every action, one row per part name; large parts are mapped under another name, so their own is a miss."""
    word = F.split("p_name", " ")[0]
    thing = F.split("p_name", " ")[1]
    action = (
        F.when(word == "red", "KEEP").when(word == "blue", "RAISE").when(word == "cold", "DELETE")
        .when(F.col("p_name") == "hot gizmo", "MANUAL LABEL")
        .otherwise(F.concat(F.lit("Any "), thing))
    )
    return (
        table(spark, sf_dir, "part").select("p_name").distinct()
        .select(
            F.initcap(word).alias("Level I"),
            F.concat(F.lit("Made Of "), thing).alias("Level II"),
            action.alias("Level III"),
            F.when(thing != "rod", thing).alias("Alevel I"),
            F.when(thing != "bolt", word).alias("Alevel II"),
            F.initcap(F.when(word == "large", F.concat(F.lit("other "), "p_name")).otherwise(F.col("p_name"))).alias("Alevel III"),
        )
    )


def labelled(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Names of the parts of each order or supplier, as its level-3 labels."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        table(spark, sf_dir, "lineitem").select(key, "l_partkey")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(key, "p_name").distinct()
        .groupBy(key).agg(F.collect_list("p_name").alias("label_level_3"))
    )


# Works ----------------------------------------------------------------------

def short_doi() -> Column:
    return F.concat(F.lit("10.5555/"), F.col("lang"), F.lit("."), F.col("n_chars").cast("string"))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as papers to look up: some by id, most by DOI, some not at all."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").alias("record_id"),
        F.when(F.col("source").isin("src1", "src2", "src3"), F.concat(F.lit("W"), F.col("doc_id").cast("string")))
        .otherwise(F.lit("")).alias("paper"),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(short_doi()).alias("doi"),
        F.concat(F.lit("http://example.org/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("title"),
        F.col("text").alias("abstract"),
        F.concat(F.lit("['"), F.col("source"), F.lit("', '"), F.col("lang"), F.lit("']")).alias("label_level_1"),
        F.when(F.col("lang") != "es", F.concat(F.lit("['In  "), F.col("lang"), F.lit("']"))).alias("label_level_2"),
        F.lit("").alias("label_level_3"),
        F.when(F.col("lang") == "fr", F.lit("Plain Venue"))
        .otherwise(F.concat(F.lit("['"), F.col("lang"), F.lit("', 'Own']"))).alias("venue_names"),
        F.concat(F.lit("["), F.col("n_chars").cast("string"), F.lit(", 0.5]")).alias("absolute_relevancy"),
    )


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as a works snapshot; DOIs repeat, some are missing."""
    name = F.concat(F.lit("Author "), F.col("source"))
    key = F.col("doc_id").cast("string")

    def ref(letter: str, value: Column) -> Column:
        return F.concat(F.lit(PREFIX + letter), value)

    def venue(i: Column, n: Column) -> Column:
        return F.struct(i.alias("id"), n.alias("display_name"))

    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            ref("W", key).alias("id"),
            F.when(F.col("quality") == 1, F.concat(F.lit("https://doi.org/"), short_doi())).alias("doi"),
            F.concat(F.lit("Title "), key).alias("title"),
            F.array(F.struct(F.col("lang").alias("descriptor_name")), F.struct(F.col("source").alias("descriptor_name"))).alias("mesh"),
            F.when(F.col("toxic") == 0, venue(ref("V", F.col("source")), F.col("source"))).alias("host_venue"),
            F.array(
                venue(F.lit(None).cast("string"), F.col("lang")), venue(ref("V", F.col("lang")), F.lit("")),
            ).alias("alternate_host_venues"),
            F.array(
                F.struct(venue(ref("A", F.col("lang")), name).alias("author")),
                F.struct(venue(F.lit(None).cast("string"), F.col("lang")).alias("author")),
            ).alias("authorships"),
            F.when(F.col("lang") != "en", F.array(ref("W", key), ref("W", F.col("lang")))).alias("referenced_works"),
            rl.invert_text(F.split("text", " ")).alias("abstract_inverted_index"),
            F.struct((F.col("quality") == 1).alias("is_oa"), F.concat(F.lit("http://oa/"), key).alias("oa_url")).alias("open_access"),
        )
    )


# Upserts --------------------------------------------------------------------

def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "record_id")


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows: orders (keys repeat, nulls, one more column) and suppliers."""
    orders = (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_custkey").alias("record_id"),
            F.col("o_totalprice").alias("c_acctbal"),
            F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("c_mktsegment"),
            F.col("o_orderpriority").alias("last_priority"),
            F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("seq"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey") + 1_000_000_000_000).alias("record_id"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.concat(F.lit("99990101"), F.col("s_name")).alias("seq"),
    )
    return rl.combine([orders, suppliers])


# Whole runs -------------------------------------------------------------------

def part_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as posts with path labels, one or two links and a date by size."""
    url = F.concat(F.lit("http://parts.example.org/"), F.col("p_partkey").cast("string"))
    path = F.concat_ws(" > ", "p_type", "p_brand", "p_name")
    links = F.when(F.col("p_size") > 25, F.array(url, F.concat(url, F.lit("/b")))).otherwise(F.array(url))
    function = F.struct(
        F.array("p_type").alias("lvl0"),
        F.array(F.concat_ws(" > ", "p_type", "p_brand")).alias("lvl1"),
        F.array(path).alias("lvl2"),
    )
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "PROMO", "Other").otherwise("Strategies").alias("post_type_label"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2023-12-20 00:00:00")) + F.col("p_size") * 86_400).alias("post_modified"),
        F.struct(function.alias("function")).alias("taxonomies_hierarchical"),
        F.when(F.col("p_size") > 25, F.struct(links.alias("source_link"))).alias("reference_sources"),
        F.struct(links.alias("source_link")).alias("sources"),
    )


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages behind the first links; gears have no DOI."""
    key = F.col("p_partkey").cast("string")
    link = F.concat(F.lit('<p><a class="l" href="https://doi.org/10.7777%p.'), key, F.lit('">doi</a></p>'))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("http://parts.example.org/"), key).alias("url"),
        F.when(F.col("p_name").endswith("gear"), F.lit("<p>none</p>")).otherwise(link).alias("html"),
    )


def part_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works of all parts with nested fields; those of small parts are known by another DOI than the parts' pages give."""
    key = F.col("p_partkey").cast("string")
    large = F.col("p_size") > 30

    def named(letter: str, value: str) -> Column:
        return F.struct(F.concat(F.lit(PREFIX + letter), F.col(value)).alias("id"), F.col(value).alias("display_name"))

    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit(PREFIX + "W"), key).alias("id"),
        F.concat(F.lit("https://doi.org/10.7777/"), F.when(F.col("p_size") > 20, "p.").otherwise("small."), key).alias("doi"),
        F.col("p_name").alias("title"),
        F.array(F.struct(F.col("p_type").alias("descriptor_name"))).alias("mesh"),
        F.when(large, named("V", "p_brand")).alias("host_venue"),
        F.array(named("U", "p_type")).alias("alternate_host_venues"),
        F.array(F.struct(named("A", "p_type").alias("author")), F.struct(named("A", "p_brand").alias("author"))).alias("authorships"),
        F.array(F.concat(F.lit(PREFIX + "W"), key), F.lit(PREFIX + "W0")).alias("referenced_works"),
        rl.invert_text(F.split("p_name", " ")).alias("abstract_inverted_index"),
        F.struct(large.alias("is_oa"), F.concat(F.lit("http://oa/"), key).alias("oa_url")).alias("open_access"),
    )
    return rl.conform(rows, works(spark, sf_dir).schema)


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as master records."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("record_id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("abstract"),
        F.lit("N").alias("isBiomimicry"),
        F.lit("").alias("doi"),
        F.concat(F.lit("http://customers.example.org/"), F.col("c_custkey").cast("string")).alias("url"),
    )
    return rl.fill_missing(rl.conform(rows, RECORD_SCHEMA), [f.name for f in RECORD_SCHEMA if f.dataType.typeName() == "array"])
