"""Filling of records from fetched pages and from a works snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.identifiers import (
    bad_work_id,
    doi_link,
    doi_of_link,
    extract_doi,
    extract_work_id,
    is_blank,
    to_key,
)
from ..functions.lists import (
    access_fields,
    any_bad_work_id,
    append_missing,
    author_lists,
    bad_list_literal,
    clean_labels,
    empty_list,
    or_empty,
    parse_list_literal,
    reference_list,
    term_names,
    venue_lists,
)
from ..functions.text import rebuild_text
from ..schemas import record_schema
from .keys import first_per_key, lookup_join
from .shaping import col_or_default

WORK = "work"
_FIELD = "_work_"
MATCHED = "matched"
UNDETERMINED = "undetermined"


def doi_from_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(url, doi)`` per page, ``""`` where the page gives no DOI."""
    return (
        pages.select(F.col(url).alias("url"), doi_link(html).alias("_link"))
        .select("url", doi_of_link("url", "_link").alias("doi"))
    )


def fill_dois(records: DataFrame, pages: DataFrame, on: str = "url", doi: str = "doi") -> DataFrame:
    """Fill blank DOIs from the pages of the records, ``%`` turned into ``/``.

    Only the found DOIs of the pages travel, never the pages. Of several DOIs
    found for one url the smallest counts. Records that have a DOI are looked
    up under no key.
    """
    # Dropping blanks inside the generator keeps the page from being searched
    # twice, as a filter pushed below the projection would.
    known = F.filter(F.array(F.regexp_replace("doi", "%", "/")), lambda d: d != "")
    found = (
        doi_from_pages(pages)
        .select(F.col("url").alias("_url"), F.explode(known).alias("_doi"))
        .groupBy("_url")
        .agg(F.min("_doi").alias("_found"))
    )
    wanted = F.when(is_blank(doi), F.col(on))
    filled = F.coalesce(F.col("_found"), F.col(doi))
    looked_up = lookup_join(records, found, wanted, F.col("_url"))
    return looked_up.withColumn(doi, filled).select(*records.columns)


def _lookup_kinds(work_id: Column, doi: Column) -> list[tuple[str, Column]]:
    return [("id", work_id), ("doi", doi)]


def works_by_key(works: DataFrame, order: list[str] | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """The snapshot under each key it is looked up by, first work per key.

    A work has two keys, its id and its DOI; ``order`` decides between works
    with the same key (default: by id), the plain columns' contents between
    works that it leaves equal. ``wanted``, a frame of one column, names the keys that are needed.

    Which work a key stands for is found on narrow rows, keys and plain columns.
    Only then the other fields move, once, and only those of works that were
    found, if there are few enough of them to be sent to the works.
    """
    short = F.coalesce(extract_work_id("id"), F.col("id"))
    doi = extract_doi(F.coalesce("doi", F.lit("")))
    named = F.array(*[F.when(~is_blank(key), F.concat(F.lit(kind + ":"), key)) for kind, key in _lookup_kinds(short, doi)])
    plain = [f.name for f in works.schema if isinstance(f.dataType, T.AtomicType)]
    # A work is told by its plain columns: two hashes, for sixty-four bits are not enough for all works.
    told = {"_a": F.xxhash64(*plain), "_b": F.xxhash64(F.lit(1), *plain)}
    by = list(dict.fromkeys([*(order or ["id"]), *plain]))
    keys = works.select(F.explode(F.array_compact(named)).alias("_work_key"), *by, *[h.alias(n) for n, h in told.items()])
    if wanted is not None:
        keys = keys.join(wanted.toDF("_work_key").distinct(), "_work_key", "left_semi")
    chosen = first_per_key(keys, ["_work_key"], by).select("_work_key", F.col("_a").alias("_of_a"), F.col("_b").alias("_of_b"))
    # The fields stay flat until after the join, so that those nobody reads are
    # pruned at the scan.
    wide = works.select(*[F.col(c).alias(_FIELD + c) for c in works.columns], doi.alias("_found_doi"), *[h.alias(n) for n, h in told.items()])
    found = wide.join(chosen, (F.col("_a") == F.col("_of_a")) & (F.col("_b") == F.col("_of_b")))
    # Works that agree in all plain columns are taken for one; which of them is not said.
    return first_per_key(found, ["_work_key"], ["_a"]).drop("_a", "_b", "_of_a", "_of_b")


def enrich_works(
    records: DataFrame,
    works: DataFrame,
    id_col: str = "paper",
    doi_col: str = "doi",
    require_doi: bool = True,
    order: list[str] | None = None,
) -> DataFrame:
    """Left lookup of each record's work: by work id if it has one, else by DOI.

    Adds the flag ``matched`` and the struct ``work``, its fields null without a
    match; the DOI of the work, if any, replaces the record's own. With ``require_doi`` records without a DOI
    are not looked up, even if they have an id.

    Each record has exactly one key, so there is one join and one exchange of
    the records; their keys are read beforehand, to look up no other works.
    """
    own_id = F.when(~is_blank(id_col), F.col(id_col)) if id_col in records.columns else F.lit(None)
    own_doi = F.when(~is_blank(doi_col), F.upper(F.col(doi_col)))
    key = F.coalesce(
        *[
            F.concat(F.lit(kind + ":"), value)
            for kind, value in _lookup_kinds(own_id.cast("string"), own_doi)
        ]
    )
    if require_doi:
        key = F.when(own_doi.isNotNull(), key)
    wanted = records.select(key.alias("_wanted")).filter(F.col("_wanted").isNotNull())
    lookup = works_by_key(works, order, wanted).withColumn("_hit", F.lit(True))
    canonical = F.when(~is_blank("_found_doi"), F.col("_found_doi"))
    return (
        lookup_join(records, lookup, key, F.col("_work_key"))
        .withColumn(MATCHED, F.col("_hit").isNotNull())
        .withColumn(WORK, F.struct(*[F.col(_FIELD + c).alias(c) for c in works.columns]))
        .withColumn(doi_col, F.coalesce(canonical, F.col(doi_col)))
        .select(*records.columns, MATCHED, WORK)
    )


def _own_list(df: DataFrame, name: str, element: str = "string") -> Column:
    """A list column in either form: a real list or a list written as text."""
    if name not in df.columns:
        return empty_list(element)
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_list_literal(name, element)
    return or_empty(F.col(name).cast(f"array<{element}>"), element)


def _own_venues(df: DataFrame) -> Column:
    """Own venue names; a text counts only when it is written as a list."""
    if "venue_names" not in df.columns:
        return empty_list()
    if isinstance(df.schema["venue_names"].dataType, T.StringType):
        return F.when(F.col("venue_names").startswith("["), parse_list_literal("venue_names")).otherwise(empty_list())
    return or_empty("venue_names")


def to_record(enriched: DataFrame, key: str = "record_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The target record: fields of the work where matched, own ones elsewhere.

    ``key`` names the key column, of the rows and of the record; ``keep`` names
    columns that go along beside the record.
    """
    work, matched = F.col(WORK), F.col(MATCHED)

    def pick(from_work: Column, own: Column | None = None) -> Column:
        return F.when(matched, from_work).otherwise(F.lit(None) if own is None else own)

    def own(name: str, default: object = None) -> Column:
        return col_or_default(enriched, name, default)

    venue_ids, venue_names = venue_lists(work["host_venue"], work["alternate_host_venues"])
    author_ids, author_names = author_lists(work["authorships"])
    is_open, link = access_fields(work["open_access"])
    labels = {f"level{k}": clean_labels(_own_list(enriched, f"label_level_{k}")) for k in (1, 2, 3)}
    fields = {
        "paper": pick(extract_work_id(work["id"]), F.coalesce(own("paper", ""), F.lit(""))),
        "mesh_terms": pick(term_names(work["mesh"]), _own_list(enriched, "mesh_terms")),
        "venue_ids": pick(venue_ids, empty_list()),
        "venue_names": append_missing(pick(venue_names, empty_list()), _own_venues(enriched)),
        "author_ids": pick(author_ids, empty_list()),
        "author_names": pick(author_names, _own_list(enriched, "author_names")),
        "reference_ids": pick(reference_list(work["referenced_works"]), empty_list()),
        "title": pick(work["title"], own("title")),
        "abstract": pick(rebuild_text(work["abstract_inverted_index"]), own("abstract")),
        "isOpenAccess": pick(F.coalesce(is_open, F.lit(False))),
        "fullDocLink": pick(link),
        key: to_key(own(key)),
        "doi": F.upper(own("doi", "")),
        **labels,
        "isBiomimicry": own("isBiomimicry", UNDETERMINED),
        "url": own("url"),
        "mag_terms": _own_list(enriched, "mag_terms"),
        "species": _own_list(enriched, "species"),
        "absolute_relevancy": _own_list(enriched, "absolute_relevancy", "double"),
        "relative_relevancy": _own_list(enriched, "relative_relevancy", "double"),
    }
    return enriched.select(
        *[fields[f.name].cast(f.dataType).alias(f.name) for f in record_schema(key)], *keep
    )


def record_checks(enriched: DataFrame) -> dict[str, Column]:
    """Row errors that keep an enriched row from becoming a record."""
    work = F.col(WORK)
    checks = {
        "work id without prefix": bad_work_id(work["id"]),
        "venue id without prefix": bad_work_id(work["host_venue"]["id"]),
        "author id without prefix": any_bad_work_id(
            F.transform(work["authorships"], lambda a: a["author"]["id"])
        ),
        "reference id without prefix": any_bad_work_id(work["referenced_works"]),
    }
    elements = {f"label_level_{k}": "string" for k in (1, 2, 3)}
    elements |= {"species": "string", "mag_terms": "string"}
    elements |= {"absolute_relevancy": "double", "relative_relevancy": "double"}
    for name, element in elements.items():
        if name in enriched.columns and isinstance(enriched.schema[name].dataType, T.StringType):
            checks[f"{name} is not a list"] = bad_list_literal(name, element)
    for name in ("mesh_terms", "author_names"):
        if name in enriched.columns and isinstance(enriched.schema[name].dataType, T.StringType):
            checks[f"{name} is not a list"] = ~F.col(MATCHED) & bad_list_literal(name)
    if "venue_names" in enriched.columns and isinstance(
        enriched.schema["venue_names"].dataType, T.StringType
    ):
        venues = F.col("venue_names")
        checks["venue_names is not a list"] = venues.startswith("[") & bad_list_literal(venues)
    return checks
