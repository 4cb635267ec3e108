"""SQL that computes the registered queries another way, for DuckDB."""

from __future__ import annotations

DOI = r"""\b(10[.][0-9]{4,}(?:[.][0-9]+)*/[^\s"&''<>]+)\b"""
PREFIX = "https://openalex.org/"

HOST = "regexp_extract(url, '//([^/]+)', 1)"
PAGE_DOI = f"'10.5555/' || {HOST} || '.' || page_id"
DOI_URL = f"CASE WHEN contains(url, '?') THEN url || '/doi/' || {PAGE_DOI} || '&v=1' ELSE url END"
FROM_URL = f"regexp_extract({{u}}, '{DOI}', 1)"

# DOI of each page, from the way its link and url were put in.
PAGE_DOIS = f"""
SELECT page_id, u AS url,
       CASE WHEN contains(url, '.com/') THEN replace({PAGE_DOI}, '/', '%')
            WHEN contains(url, '.net/') THEN ''
            ELSE regexp_extract(u, '{DOI}', 1) END AS doi
FROM (SELECT *, {DOI_URL} AS u FROM pages)
"""

LABEL_MAP = """
SELECT DISTINCT
  lower(upper(w[1:1]) || w[2:]) AS to1, 'made of ' || t AS to2,
  CASE w WHEN 'red' THEN 'keep' WHEN 'blue' THEN 'raise' WHEN 'cold' THEN 'delete'
         ELSE CASE WHEN p_name = 'hot gizmo' THEN 'manual label' ELSE 'any ' || t END END AS action,
  CASE WHEN t <> 'rod' THEN t ELSE '' END AS from1,
  CASE WHEN t <> 'bolt' THEN w ELSE '' END AS from2,
  CASE w WHEN 'large' THEN 'other ' ELSE '' END || p_name AS from3
FROM (SELECT p_name, split_part(p_name, ' ', 1) AS w, split_part(p_name, ' ', 2) AS t FROM part)
"""

MAPPED = f"""
WITH m AS ({LABEL_MAP}),
l AS (SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT l.*, m.*, m.from3 IS NOT NULL AS hit,
             coalesce(m.action NOT IN ('delete', 'manual label'), false) AS ok
      FROM l LEFT JOIN m ON p_name = from3),
g AS (SELECT l_orderkey,
  coalesce(list_sort(list(DISTINCT to1) FILTER (ok)), []) AS level1,
  coalesce(list_sort(list(DISTINCT to2) FILTER (ok)), []) AS level2,
  coalesce(list_sort(list(DISTINCT CASE WHEN action = 'keep' THEN p_name ELSE action END)
    FILTER (ok AND action <> 'raise')), []) AS level3,
  coalesce(list_sort(list(DISTINCT from1) FILTER (hit AND from1 <> '')), []) AS s1,
  coalesce(list_sort(list(DISTINCT from2) FILTER (hit AND from2 <> '')), []) AS s2,
  coalesce(list_sort(list(DISTINCT from3) FILTER (hit)), []) AS s3,
  bool_or(coalesce(action = 'manual label', false)) AS flag,
  coalesce(list_sort(list(DISTINCT p_name) FILTER (NOT hit)), []) AS misses
  FROM j GROUP BY l_orderkey)
"""


def _text(name: str, alias: str) -> str:
    return f"array_to_string({name}, '|') AS {alias}"


MAP_LABELS = MAPPED + f"""
SELECT l_orderkey, {_text('level1', 'level1')}, {_text('level2', 'level2')}, {_text('level3', 'level3')},
  {_text('s1', 'source_level1')}, {_text('s2', 'source_level2')}, {_text('s3', 'source_level3')},
  flag AS needs_review, {_text('misses', 'unmatched_labels')} FROM g
"""

CONVERTED = MAPPED + f"""
SELECT l_orderkey, {_text('level3', 'label_level_3')}, {_text('level1', 'label_level_1')},
  {_text('level2', 'label_level_2')}, {_text('s1', 'ask_label_level_1')}, {_text('s2', 'ask_label_level_2')},
  {_text('s3', 'ask_label_level_3')}, {_text('misses', 'unmatched_labels')}
"""

ORDER_LINES = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
LINE_OUT = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def _per_key(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ORDER_LINES.split(", "))
    return (
        f"SELECT {LINE_OUT} FROM lineitem QUALIFY row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"
    )


UPDATES = """
u AS (SELECT o_custkey AS record_id, o_totalprice AS c_acctbal,
        CASE WHEN o_orderpriority NOT LIKE '1%' THEN o_orderpriority END AS c_mktsegment,
        o_orderpriority AS last_priority,
        strftime(o_orderdate, '%Y%m%d') || lpad(o_orderkey::VARCHAR, 12, '0') AS seq,
        NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey
      FROM orders
      UNION ALL BY NAME
      SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey + 1000000000000 END AS record_id, s_name AS c_name,
        s_nationkey AS c_nationkey, s_acctbal AS c_acctbal, '99990101' || s_name AS seq FROM supplier),
w AS (SELECT * FROM u WHERE record_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY seq DESC) = 1)
"""


def _merged(keep_old: bool) -> str:
    def value(name: str) -> str:
        new = f"coalesce(w.{name}, c.{name})" if keep_old else f"w.{name}"
        return f"CASE WHEN w.record_id IS NOT NULL THEN {new} ELSE c.{name} END AS {name}"

    columns = ", ".join(value(n) for n in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    return (
        f"SELECT c.c_custkey AS record_id, {columns}, w.last_priority "
        "FROM (SELECT *, c_custkey AS record_id FROM customer) c LEFT JOIN w ON w.record_id = c.c_custkey"
    )


INSERTS = "SELECT * FROM u WHERE record_id IS NULL OR record_id NOT IN (SELECT c_custkey FROM customer)"

PAPERS = f"""
p AS (SELECT doc_id, lang, source, text, n_chars,
        CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'W' || doc_id ELSE '' END AS paper,
        CASE WHEN lang = 'de' THEN '' ELSE '10.5555/' || lang || '.' || n_chars END AS doi
      FROM documents),
k AS (SELECT '{PREFIX}W' || doc_id AS id, 'W' || doc_id AS short, doc_id AS work_doc,
        CASE WHEN quality = 1 THEN upper('10.5555/' || lang || '.' || n_chars) END AS work_doi,
        'Title ' || doc_id AS work_title, lang AS w_lang, source AS w_source, text AS w_text, quality, toxic
      FROM documents JOIN labels USING (doc_id)),
d AS (SELECT * FROM k WHERE work_doi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY work_doi ORDER BY id) = 1)
"""


def _enriched(require_doi: bool) -> str:
    by_id = "p.paper <> ''" + (" AND p.doi <> ''" if require_doi else "")
    return PAPERS + f""",
hit AS (SELECT p.*, k.* FROM p JOIN k ON {by_id} AND k.short = p.paper
        UNION ALL SELECT p.*, d.* FROM p JOIN d ON p.paper = '' AND p.doi <> '' AND d.work_doi = upper(p.doi)),
e AS (SELECT *, true AS matched FROM hit
      UNION ALL BY NAME SELECT *, false AS matched FROM p WHERE doc_id NOT IN (SELECT doc_id FROM hit))
"""


ENRICHED_OUT = "doc_id, matched, id AS work_id, coalesce(work_doi, doi) AS doi"

RULE_COLUMNS = (
    "rule", "column", "element_count", "missing_count", "unexpected_count", "unexpected_percent", "success", "sample",
)


def _rule(rule, column, table, bad, elements="true", missing="false", of=None, success=None, mostly=1.0, sample=None):
    """One result row: counts over a table, as :data:`RULE_COLUMNS`."""
    of = of or "n - m"
    ok = success or f"({of}) = 0 OR (({of}) - b) / ({of}) >= {mostly}"
    shown = f", {sample or 'NULL'} AS sample" if sample != "none" else ""
    return f"""
SELECT '{rule}' AS rule, '{column}' AS "column", n AS element_count, m AS missing_count, b AS unexpected_count,
  CASE WHEN ({of}) = 0 THEN 0.0 ELSE round(100.0 * b / ({of}), 6) END::DOUBLE AS unexpected_percent,
  ({ok}) AS success{shown}
FROM (SELECT count(*) FILTER ({elements}) AS n, count(*) FILTER (({elements}) AND ({missing})) AS m,
  count(*) FILTER (({elements}) AND coalesce({bad}, false)) AS b FROM {table})
"""


def _unique_rule(rule, column, table, success=None, mostly=1.0, elements="true", sample="none", blank="''"):
    ok = success or f"n - m = 0 OR (n - m - b) / (n - m) >= {mostly}"
    shown = f", {sample} AS sample" if sample != "none" else ""
    return f"""
SELECT '{rule}' AS rule, '{column}' AS "column", n::BIGINT AS element_count, m::BIGINT AS missing_count,
  b::BIGINT AS unexpected_count,
  CASE WHEN n - m = 0 THEN 0.0 ELSE round(100.0 * b / (n - m), 6) END::DOUBLE AS unexpected_percent, ({ok}) AS success{shown}
FROM (SELECT coalesce(sum(c), 0) AS n, coalesce(sum(c) FILTER (v IS NULL), 0) AS m,
  coalesce(sum(c - 1) FILTER (v::VARCHAR <> {blank} AND c > 1), 0) AS b
  FROM (SELECT {column} AS v, count(*) FILTER ({elements}) AS c FROM {table} GROUP BY 1))
"""


def _sample(value: str, table: str, bad: str) -> str:
    """The 20 smallest bad values as text."""
    return (
        f"(SELECT coalesce(string_agg(v, '|' ORDER BY v), '') FROM "
        f"(SELECT {value}::VARCHAR AS v FROM {table} WHERE {bad} ORDER BY v LIMIT 20))"
    )


def _repeats(column: str, table: str) -> str:
    return (
        f"(SELECT coalesce(string_agg(v, '|' ORDER BY v), '') FROM (SELECT {column}::VARCHAR AS v FROM {table} "
        f"GROUP BY {column} HAVING count(*) > 1 AND {column}::VARCHAR <> '' ORDER BY v LIMIT 20))"
    )


NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE = "expect_column_proportion_of_unique_values_to_be_between"
NON_EMPTY = "expect_non_empty_unique"
IS_LIST = "expect_type_list"
LIST_IN_SET = "expect_column_list_to_be_in_set"

DOCS = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
TEXTS = (
    "(SELECT doc_id, text FROM documents "
    "UNION ALL SELECT doc_id, CASE WHEN lang = 'de' THEN '' END FROM documents WHERE lang IN ('de', 'es'))"
)
WORDS = "(SELECT string_split(p_name, ' ') AS words FROM part)"
ALLOWED = "['red', 'blue', 'small', 'ring', 'rod', 'anvil', 'bolt', 'gear', 'plate', 'gizmo', 'widget']"
BAD_WORDS = f"NOT list_has_all({ALLOWED}, words)"
BAD_PRIORITY = "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"

_NO_COUNTS = (
    "NULL::BIGINT AS element_count, NULL::BIGINT AS missing_count, NULL::BIGINT AS unexpected_count, "
    "NULL::DOUBLE AS unexpected_percent"
)


def _static(rule: str, column: str | None, success: bool, more: str = "") -> str:
    name = "NULL::VARCHAR" if column is None else f"'{column}'"
    return f"""SELECT '{rule}' AS rule, {name} AS "column", {_NO_COUNTS}, {str(success).lower()} AS success{more}"""


def _union(*parts: str) -> str:
    return " UNION ALL BY NAME ".join(f"({p})" for p in parts)


def _mean_rule(column: str, table: str, elements: str, low: float, high: float) -> str:
    return f"""
SELECT 'expect_column_mean_to_be_between' AS rule, '{column}' AS "column", count(*) AS element_count,
  count(*) FILTER ({column} IS NULL) AS missing_count, NULL::BIGINT AS unexpected_count, NULL::DOUBLE AS unexpected_percent,
  coalesce(avg({column}) BETWEEN {low} AND {high}, false) AS success FROM {table} WHERE {elements}
"""


LOW = "o_orderpriority NOT IN ('5-LOW')"
STATUS = "o_orderstatus NOT IN ('F', 'O')"


def _suite(sample: bool) -> list[str]:
    """The seven rules of the order suite."""
    def s(text):
        return {"sample": text if sample else "none"}

    empty = ", '' AS sample" if sample else ""
    return [
        _rule(NOT_NULL, "o_orderkey", "orders", "o_orderkey IS NULL", missing="o_orderkey IS NULL", of="n", **s("''")),
        _unique_rule(UNIQUE, "o_orderkey", "orders", success="n - m = 0 OR (n - m - b) / (n - m) = 1", **s(_repeats("o_orderkey", "orders"))),
        _rule(IN_SET, "o_orderstatus", "orders", STATUS, missing="o_orderstatus IS NULL", mostly=0.6, **s(_sample("o_orderstatus", "orders", STATUS))),
        _rule(IN_SET, "o_orderpriority", "orders", LOW, missing="o_orderpriority IS NULL", **s(_sample("o_orderpriority", "orders", LOW))),
        _unique_rule(NON_EMPTY, "o_custkey", "orders", **s(_repeats("o_custkey", "orders"))),
        _static(NOT_NULL, "no_such_column", False, empty),
        _static(LIST_IN_SET, "o_orderstatus", False, empty),
    ]


def _broken(parts: list[str]) -> str:
    return _union(
        *[f"SELECT *, {'true' if i >= 5 else 'false'} AS broken FROM ({p})" for i, p in enumerate(parts)]
    )


def _stored() -> str:
    keep = 'rule, "column", unexpected_count, success'
    first = [f"SELECT 'run-1' AS run_id, {keep} FROM ({p})" for p in _suite(False)]
    second = [f"SELECT 'run-2' AS run_id, {keep} FROM ({p})" for p in _suite(False)[:3]]
    return _union(*first, *second)


EVENTS = """
WITH e AS (SELECT event_id,
    CASE WHEN event_type = 'error' THEN 'u' || user_id ELSE user_id::VARCHAR END AS user_key,
    CASE WHEN value > 300 THEN '<' || props ELSE props END AS props FROM events),
c AS (SELECT *, CASE WHEN TRY_CAST(user_key AS BIGINT) IS NULL THEN 'key is not a number'
    WHEN props LIKE '<%' THEN 'props are not json' END AS error_reason FROM e)
"""

WORD_AUTHORS = "string_split(text, ' ')"


RECORD = (
    "paper mesh_terms venue_ids venue_names author_ids author_names reference_ids title abstract isOpenAccess "
    "fullDocLink record_id doi level1 level2 level3 isBiomimicry url mag_terms species absolute_relevancy relative_relevancy"
).split()
LISTS = (
    "mesh_terms venue_ids venue_names author_ids author_names reference_ids level1 level2 level3 mag_terms species "
    "absolute_relevancy relative_relevancy"
).split()

TO_RECORD = f"""
        SELECT CASE WHEN matched THEN short ELSE paper END AS paper,
          CASE WHEN matched THEN w_lang || '|' || w_source ELSE '' END AS mesh_terms,
          CASE WHEN toxic = 0 THEN '{PREFIX}V' || w_lang || '|V' || w_source ELSE '' END AS venue_ids,
          array_to_string(list_concat(v, list_filter(o, lambda x: NOT list_contains(v, x))), '|') AS venue_names,
          CASE WHEN matched THEN 'A' || w_lang || '|' ELSE '' END AS author_ids,
          CASE WHEN matched THEN 'Author ' || w_source || '|' || w_lang ELSE '' END AS author_names,
          CASE WHEN matched AND w_lang <> 'en' THEN 'W' || work_doc || '|W' || w_lang ELSE '' END AS reference_ids,
          CASE WHEN matched THEN work_title ELSE source END AS title,
          CASE WHEN matched THEN w_text ELSE text END AS abstract,
          CASE WHEN matched THEN quality = 1 END AS isOpenAccess,
          CASE WHEN matched THEN 'http://oa/' || work_doc END AS fullDocLink,
          doc_id AS record_id, upper(coalesce(work_doi, doi)) AS doi,
          source || '|' || lang AS level1, CASE WHEN lang <> 'es' THEN 'in__' || lang ELSE '' END AS level2, '' AS level3,
          'undetermined' AS isBiomimicry, 'http://example.org/' || source || '/' || doc_id AS url,
          '' AS mag_terms, '' AS species, n_chars || '.0|0.5' AS absolute_relevancy, '' AS relative_relevancy
        FROM (SELECT *, CASE WHEN toxic = 0 THEN [w_lang, w_source] ELSE [] END AS v,
                CASE WHEN lang = 'fr' THEN [] ELSE [lang, 'Own'] END AS o FROM e)
"""

# Customers as records: empty lists, most other fields missing.
CUSTOMERS = (
    "SELECT c_custkey AS record_id, c_name AS title, c_mktsegment AS abstract, 'N' AS isBiomimicry, '' AS doi, "
    "'http://customers.example.org/' || c_custkey AS url, NULL::VARCHAR AS paper, NULL::BOOLEAN AS isOpenAccess, "
    "NULL::VARCHAR AS fullDocLink, " + ", ".join(f"'' AS {n}" for n in LISTS) + " FROM customer"
)


def _run_candidate(records: str, order: str) -> str:
    """Customers updated by the records of the same key, then the other records."""
    columns = ", ".join(
        f"CASE WHEN r.url IS NOT NULL THEN r.{n} ELSE c.{n} END AS {n}" for n in RECORD if n != "record_id"
    )
    return f"""
cust AS ({CUSTOMERS}), r AS ({records}),
new AS (SELECT * FROM r WHERE record_id IS NULL OR record_id NOT IN (SELECT record_id FROM cust))
SELECT c.record_id, {columns} FROM cust c LEFT JOIN r ON r.record_id = c.record_id
UNION ALL BY NAME
SELECT * REPLACE ((SELECT max(record_id) FROM cust) + row_number() OVER (ORDER BY {order}) AS record_id) FROM new
"""


MERGE_RUN = f"WITH {_enriched(True)}, " + _run_candidate(
    f"SELECT * FROM ({TO_RECORD}) WHERE url NOT LIKE 'http://example.org/src4/%'", "url, doi"
)

# The lines of an inbox with values that are not of their type.
LOSSY = """
lossy AS (
  SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN '<' ELSE '' END || printf('%.2f', o_totalprice) AS price,
    CASE left(o_orderpriority, 1) WHEN '1' THEN '[''open' WHEN '2' THEN '[''a''; ''b'']' ELSE '[''a'']' END AS tags,
    CASE WHEN o_orderstatus = 'P' THEN 'more' ELSE 'one' END AS note, o_orderstatus = 'P' AS ragged, 'csv' AS kind,
    o_orderkey || ',' || price || ',' || tags || ',' || CASE WHEN o_orderstatus = 'P' THEN 'more,fields' ELSE 'one' END AS line
  FROM orders
  UNION ALL BY NAME
  SELECT c_custkey AS key, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE printf('%.2f', c_acctbal) END AS price,
    CASE c_mktsegment WHEN 'BUILDING' THEN c_mktsegment ELSE '[''b'']' END AS tags, false AS ragged, 'json' AS kind
  FROM customer)
"""

# Posts of the parts after conversion, one row per link.
POSTED = f"""
m AS ({LABEL_MAP}),
posted AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, unnest(CASE WHEN p_size > 25 THEN ['', '/b'] ELSE [''] END) AS tail
           FROM part WHERE p_type <> 'PROMO' AND p_size > 12),
q AS (SELECT *, 'http://parts.example.org/' || p_partkey || tail AS url,
        CASE WHEN tail = '' AND p_name NOT LIKE '%gear' THEN '10.7777/p.' || p_partkey ELSE '' END AS doi,
        action IN ('keep', 'raise') OR action LIKE 'any %' AS ok
      FROM posted LEFT JOIN m ON p_name = from3)
"""

FULL_RUN = f"WITH {POSTED}, " + _run_candidate(
    f"""
    SELECT CASE WHEN w THEN 'W' || p_partkey ELSE '' END AS paper, CASE WHEN w THEN p_type ELSE '' END AS mesh_terms,
      CASE WHEN w AND p_size > 30 THEN '{PREFIX}U' || p_type || '|V' || p_brand ELSE '' END AS venue_ids,
      CASE WHEN w AND p_size > 30 THEN p_type || '|' || p_brand ELSE '' END AS venue_names,
      CASE WHEN w THEN 'A' || p_type || '|A' || p_brand ELSE '' END AS author_ids,
      CASE WHEN w THEN p_type || '|' || p_brand ELSE '' END AS author_names,
      CASE WHEN w THEN 'W' || p_partkey || '|W0' ELSE '' END AS reference_ids, CASE WHEN w THEN p_name ELSE '' END AS title,
      CASE WHEN w THEN p_name ELSE '' END AS abstract, CASE WHEN w THEN p_size > 30 END AS isOpenAccess,
      CASE WHEN w THEN 'http://oa/' || p_partkey END AS fullDocLink, NULL::BIGINT AS record_id,
      upper(doi) AS doi, CASE WHEN ok THEN to1 ELSE '' END AS level1,
      CASE WHEN ok THEN replace(to2, ' ', '_') ELSE '' END AS level2,
      CASE WHEN action = 'keep' THEN replace(p_name, ' ', '_') WHEN action LIKE 'any %' THEN replace(action, ' ', '_') ELSE '' END AS level3,
      'Y' AS isBiomimicry, url, '' AS mag_terms, '' AS species, '' AS absolute_relevancy, '' AS relative_relevancy
    FROM (SELECT *, doi <> '' AND p_size > 20 AS w FROM q) WHERE action IS DISTINCT FROM 'manual label'
    """,
    "url, doi",
)

SQL: dict[str, str] = {
    "incremental_since_month_start": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_orderdate > date_trunc('month', TIMESTAMP '2001-07-15')""",
    "month_counts": """
        SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS n_orders
        FROM orders GROUP BY 1""",
    "explode_references": """
        SELECT page_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS url FROM (
          SELECT page_id, CASE WHEN contains(url, '?') THEN [url] WHEN url LIKE '%/' THEN []
            ELSE regexp_extract_all(html, 'href="([^"]*)"', 1) END AS l FROM pages)""",
    "with_constants_conform": """
        SELECT '' AS title, c_custkey, 'Y' AS isBiomimicry, '' AS abstract, c_mktsegment FROM customer""",
    "fill_and_drop_missing": """
        SELECT doc_id, source AS url, CASE WHEN quality = 1 THEN lang ELSE '' END AS good_lang,
          CASE WHEN toxic = 0 THEN lang || '|' || source ELSE '' END AS tags,
          'undetermined' AS verdict, CASE WHEN toxic = 0 THEN 2 ELSE 0 END AS n_tags
        FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (lang = 'es' AND quality IS NULL)""",
    "sort_records": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 1000""",
    "extract_doi": f"""
        SELECT page_id, CASE WHEN contains(url, '.com/') THEN upper({PAGE_DOI}) ELSE '' END AS doi FROM pages""",
    "doi_from_url": f"""
        SELECT page_id, regexp_extract({DOI_URL}, '{DOI}', 1) AS doi FROM pages""",
    "doi_from_pages": f"SELECT url, doi FROM ({PAGE_DOIS})",
    "fill_dois": f"""
        WITH d AS ({PAGE_DOIS})
        SELECT page_id, d.url, CASE WHEN p.url LIKE '%/' THEN '10.1/own' ELSE replace(d.doi, '%', '/') END AS doi
        FROM pages p JOIN d USING (page_id)""",
    "extract_work_id": """
        SELECT doc_id, CASE lang WHEN 'en' THEN 'W' || doc_id WHEN 'fr' THEN NULL ELSE '' END AS work_id FROM documents""",
    "to_key": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS record_id FROM orders""",
    "path_levels": """
        SELECT p_partkey, p_type || '|' || p_name AS level1, p_brand AS level2,
          CASE WHEN p_size > 25 THEN p_name ELSE '' END AS level3 FROM part""",
    "post_labels": """
        SELECT p_partkey, p_type AS label_level_1, CASE WHEN p_size > 10 THEN p_brand ELSE '' END AS label_level_2,
          p_name || '|' || p_name AS label_level_3 FROM part""",
    "parse_list_literal": """
        SELECT p_partkey, CASE WHEN p_size > 5 THEN lower(p_type) || '|' || lower(p_name) || '''s' ELSE '' END AS labels,
          CASE WHEN p_size > 5 THEN 2 ELSE 0 END AS n_labels FROM part""",
    "clean_labels": r"""
        SELECT p_partkey, lower(regexp_replace(p_name, '\s', '_', 'g')) || '|' || lower(p_type) || '___' || lower(p_brand) AS labels
        FROM part""",
    "append_missing": """
        WITH a AS (SELECT p_partkey, [p_type, p_brand] AS own,
          [p_name, p_brand, p_name, CASE WHEN p_size > 25 THEN 'PROMO' ELSE 'big' END] AS more FROM part)
        SELECT p_partkey, array_to_string(list_concat(own, list_filter(more, lambda x: NOT list_contains(own, x))), '|') AS names
        FROM a""",
    "author_lists": f"""
        SELECT conv_id, turn,
          array_to_string(list_transform(w, lambda x: CASE WHEN x LIKE '%,' THEN '' ELSE 'A' || x END), '|') AS author_ids,
          array_to_string(w, '|') AS author_names
        FROM (SELECT conv_id, turn, {WORD_AUTHORS} AS w FROM conversations)""",
    "venue_lists": f"""
        SELECT conv_id, turn,
          array_to_string(list_append(
            list_transform(list_filter(w, lambda x: x NOT LIKE '%,'), lambda x: '{PREFIX}V' || x), role), '|') AS venue_ids,
          array_to_string(list_append(list_filter(w, lambda x: x NOT LIKE '%,' AND x <> ''), role), '|') AS venue_names
        FROM (SELECT *, string_split(text, ' ') AS w FROM conversations)""",
    "work_fields": f"""
        SELECT '{PREFIX}W' || doc_id AS id, lang || '|' || source AS mesh_terms,
          CASE WHEN lang <> 'en' THEN 'W' || doc_id || '|W' || lang ELSE '' END AS reference_ids,
          quality = 1 AS is_open, 'http://oa/' || doc_id AS link
        FROM documents JOIN labels USING (doc_id)""",
    "rebuild_text": """
        WITH w AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents),
        m AS (SELECT doc_id, ws, list_max(list_transform(ws, lambda x, i: CASE WHEN x LIKE '%,' THEN 0 ELSE i END)) AS last FROM w)
        SELECT doc_id, array_to_string(list_transform(ws[1:last], lambda x: CASE WHEN x LIKE '%,' THEN '-' ELSE x END), ' ') AS text,
          CASE WHEN last > 0 THEN (last - 1)::INTEGER END AS last_position FROM m""",
    "load_label_map": LABEL_MAP,
    "load_label_map_filled": f"""
        WITH m AS ({LABEL_MAP}),
        g AS (SELECT *, count(nullif(from1, '')) OVER o AS grp FROM m WINDOW o AS (ORDER BY from3))
        SELECT to1, to2, action,
          coalesce(last_value(nullif(from1, '') IGNORE NULLS) OVER (ORDER BY from3 ROWS UNBOUNDED PRECEDING), '') AS from1,
          coalesce(last_value(nullif(from2, '') IGNORE NULLS) OVER (PARTITION BY grp ORDER BY from3 ROWS UNBOUNDED PRECEDING), '') AS from2,
          from3 FROM g""",
    "map_labels": MAP_LABELS,
    "map_labels_large_map": MAP_LABELS,
    "convert_taxonomy": CONVERTED + ", flag AS manual_label FROM g",
    "route_auto": CONVERTED + "FROM g WHERE NOT flag",
    "route_review": CONVERTED + "FROM g WHERE flag",
    "combine": """
        SELECT c_custkey AS party, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS party, s_acctbal AS balance FROM supplier
        UNION ALL BY NAME SELECT p_name AS name, p_brand AS brand FROM part""",
    "first_per_key": _per_key("ASC"),
    "last_per_key": _per_key("DESC"),
    "assign_sequential_ids": """
        SELECT o_totalprice, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS record_id,
          o_orderkey FROM orders""",
    "upsert_update": f"WITH {UPDATES} {_merged(False)}",
    "upsert_keep_old": f"WITH {UPDATES} {_merged(True)}",
    "upsert_repeated_master": """
        SELECT o_custkey AS record_id, o_orderkey, CASE WHEN c_name IS NULL THEN o_totalprice ELSE c_acctbal END AS o_totalprice,
          o_orderpriority, c_mktsegment AS segment
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth FROM orders)
        LEFT JOIN customer ON o_custkey = c_custkey AND nth = 1""",
    "upsert_insert": f"WITH {UPDATES} {INSERTS}",
    "upsert": f"""
        WITH {UPDATES}, i AS ({INSERTS})
        SELECT * FROM ({_merged(False)})
        UNION ALL BY NAME
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY seq) AS record_id,
          c_name, c_nationkey, c_acctbal, c_mktsegment, last_priority FROM i""",
    "merge_ranges": f"""
        WITH {UPDATES}, i AS ({INSERTS})
        SELECT * FROM ({_merged(False)})
        UNION ALL BY NAME
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY seq) AS record_id,
          c_name, c_nationkey, c_acctbal, c_mktsegment, last_priority FROM i""",
    "enrich_works": f"WITH {_enriched(True)} SELECT {ENRICHED_OUT}, work_title AS title FROM e",
    "enrich_without_doi": f"WITH {_enriched(False)} SELECT {ENRICHED_OUT} FROM e",
    "to_record": f"WITH {_enriched(True)} {TO_RECORD}",
    "rule_not_null": _union(
        _rule(NOT_NULL, "quality", DOCS, "quality IS NULL", missing="quality IS NULL", of="n", sample="''"),
        _rule(NOT_NULL, "text", DOCS, "text IS NULL", missing="text IS NULL", of="n", sample="''"),
    ),
    "rule_in_set": _union(
        _rule(IN_SET, "o_orderpriority", "orders", BAD_PRIORITY, missing="o_orderpriority IS NULL",
              sample=_sample("o_orderpriority", "orders", BAD_PRIORITY)),
        _rule(IN_SET, "o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O', 'P')", missing="o_orderstatus IS NULL",
              sample=_sample("o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O', 'P')")),
    ),
    "rule_unique_proportion": _union(
        _unique_rule(UNIQUE, "l_orderkey", "lineitem", success="(n - m - b) / (n - m) BETWEEN 0.1 AND 0.5", sample=_repeats("l_orderkey", "lineitem")),
        _unique_rule(UNIQUE, "l_orderkey", "lineitem", success="(n - m - b) / (n - m) = 1", sample=_repeats("l_orderkey", "lineitem")),
    ),
    "rule_non_empty_unique": _union(
        _unique_rule(NON_EMPTY, "text", TEXTS), _unique_rule(NON_EMPTY, "doc_id", TEXTS), _unique_rule(NON_EMPTY, "text", TEXTS, mostly=0.5),
    ),
    "rule_list_in_set": _rule(
        LIST_IN_SET, "words", WORDS, BAD_WORDS, missing="words IS NULL",
        sample=_sample("""'["' || array_to_string(words, '","') || '"]'""", WORDS, BAD_WORDS),
    ),
    "rule_is_list": _union(
        _rule(IS_LIST, "embedding", "embeddings", "embedding IS NULL", missing="embedding IS NULL", of="n", sample="none"),
        _rule(IS_LIST, "some", "embeddings", "label <= 2 OR label IS NULL", missing="label <= 2 OR label IS NULL", of="n", sample="none"),
        _rule(IS_LIST, "vec_id", "embeddings", "true", missing="vec_id IS NULL", of="n", sample="none"),
    ),
    "rule_schema": _union(
        _static("expect_table_columns_to_match_ordered_list", None, True),
        _static("expect_table_columns_to_match_ordered_list", None, False),
        _static("expect_column_values_to_be_in_type_list", "o_orderkey", True),
        _static("expect_column_values_to_be_in_type_list", "o_totalprice", False),
        _rule(NOT_NULL, "o_orderkey", "orders", "o_orderkey IS NULL", missing="o_orderkey IS NULL", of="n", sample="none"),
    ),
    "rule_mostly_and_condition": _union(
        *[
            _rule(IN_SET, "l_returnflag", "lineitem", "l_returnflag NOT IN ('A', 'R')", missing="l_returnflag IS NULL",
                  sample="none", mostly=mostly, elements=elements)
            for mostly, elements in ((0.5, "true"), (0.9, "true"), (1.0, "l_linestatus = 'F'"), (1.0, "l_quantity < 0"))
        ],
        _unique_rule(NON_EMPTY, "l_orderkey", "lineitem", mostly=0.1, elements="l_linenumber = 1"),
    ),
    "aggregate_rules": _union(
        _mean_rule("o_totalprice", "orders", "true", 0, 1_000_000_000),
        _mean_rule("o_totalprice", "orders", "o_orderstatus = 'F'", 0, 1),
        """SELECT 'expect_values_to_occur_at_most' AS rule, 'o_custkey' AS "column", sum(c)::BIGINT AS element_count, 0 AS missing_count,
          coalesce(sum(c) FILTER (c > 12), 0)::BIGINT AS unexpected_count,
          round(100.0 * coalesce(sum(c) FILTER (c > 12), 0) / sum(c), 6)::DOUBLE AS unexpected_percent,
          1 - coalesce(sum(c) FILTER (c > 12), 0) / sum(c) >= 0.5 AS success
          FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey)""",
        _unique_rule(NON_EMPTY, "o_custkey", "orders"),
        _rule(NOT_NULL, "o_totalprice", "orders", "o_totalprice IS NULL", missing="o_totalprice IS NULL", of="n", sample="none"),
    ),
    "bad_values": f"""
        SELECT 2 AS position, '{IN_SET}' AS rule, 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
        UNION ALL SELECT 3, '{IN_SET}', 'o_orderpriority', o_orderpriority FROM orders WHERE {LOW}
        UNION ALL SELECT 4, '{NON_EMPTY}', 'o_custkey', o_custkey::VARCHAR FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "unexpected_keys": """
        SELECT o_custkey::VARCHAR AS value, count(*) AS unexpected_count FROM orders GROUP BY o_custkey HAVING count(*) > 12""",
    "metric_states": "SELECT * EXCLUDE unexpected_percent FROM (" + _union(
        _rule(NOT_NULL, "o_orderkey", "orders", "o_orderkey IS NULL", missing="o_orderkey IS NULL", of="n", sample="none"),
        _rule(IN_SET, "o_orderpriority", "orders", "o_orderpriority NOT IN ('1-URGENT', '5-LOW')", missing="o_orderpriority IS NULL",
              mostly=0.1, sample="none"),
        _rule(IN_SET, "o_orderstatus", "orders", "o_orderstatus <> 'F'", missing="o_orderstatus IS NULL", sample="none"),
        f"""SELECT '{UNIQUE}' AS rule, 'o_orderkey' AS "column", count(*) AS element_count, 0 AS missing_count,
          NULL::BIGINT AS unexpected_count, 0.0 AS unexpected_percent, count(DISTINCT o_orderkey) / count(*) >= 0.8 AS success FROM orders""",
        f"""SELECT '{NON_EMPTY}' AS rule, 'o_custkey' AS "column", count(*) AS element_count, 0 AS missing_count,
          NULL::BIGINT AS unexpected_count, 0.0 AS unexpected_percent, count(DISTINCT o_custkey) = count(*) AS success FROM orders""",
    ) + ")",
    "unexpected_rows": f"SELECT {LINE_OUT} FROM lineitem WHERE l_linestatus = 'O' AND l_discount <= 0",
    "unexpected_repeats": """
        SELECT doc_id, text FROM documents WHERE text <> ''
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1""",
    "unexpected_values": """
        SELECT l_partkey::VARCHAR AS value, count(*) - 1 AS unexpected_count FROM lineitem
        GROUP BY l_partkey HAVING count(*) > 1""",
    "run_suite": _broken(_suite(True)),
    "suite_verdict": f"""
        SELECT 'all' AS suite, bool_and(success) AS passed FROM ({_union(*_suite(False))})
        UNION ALL SELECT 'first three' AS suite, bool_and(success) AS passed FROM ({_union(*_suite(False)[:3])})""",
    "check_suite": f"""
        SELECT *, rule = 'expect_something_unknown' AS broken FROM ({_union(
            _suite(False)[0], _static("expect_something_unknown", "o_orderpriority", False), _suite(False)[2])})""",
    "promote_if_valid": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, 'good' AS candidate FROM orders""",
    "quarantine_good": EVENTS + """
        SELECT event_id, user_key::BIGINT AS user_id, json_extract(props, '$.k')::INTEGER AS k FROM c WHERE error_reason IS NULL""",
    "quarantine_rejects": EVENTS + "SELECT event_id, user_key, props, error_reason FROM c WHERE error_reason IS NOT NULL",
    "latest_batch": """
        SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events
        WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)""",
    "csv_round_trip": """
        SELECT doc_id, text, CASE WHEN lang <> 'es' THEN lang END AS note, lang || '|' || source AS tags, n_chars FROM documents""",
    "json_round_trip": """
        SELECT doc_id, text, CASE WHEN lang <> 'es' THEN lang END AS note, lang || '|' || source AS tags, n_chars FROM documents""",
    "write_all": """
        SELECT doc_id, text, CASE WHEN lang <> 'es' THEN lang END AS note, lang || '|' || source AS tags, n_chars, copy
        FROM documents CROSS JOIN (VALUES ('csv'), ('json')) AS c(copy)""",
    "read_inbox": """
        SELECT c_custkey AS party, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS party, s_acctbal AS balance FROM supplier
        UNION ALL BY NAME SELECT p_name AS name, p_partkey AS party FROM part""",
    "ingest_inbox": "SELECT event_id, user_id, event_type, value, props FROM events",
    "ingest_layouts": """
        SELECT c_custkey AS party, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS party, s_acctbal AS balance FROM supplier
        UNION ALL BY NAME SELECT p_name AS name, p_partkey AS party FROM part
        UNION ALL BY NAME SELECT n_name AS name, n_nationkey AS party FROM nation""",
    "rescued_good": f"""
        WITH {LOSSY}
        SELECT key, CASE WHEN price IS NOT NULL THEN price::DOUBLE END AS price, regexp_extract(tags, '[a-z]') AS tags, note FROM lossy
        WHERE price NOT LIKE '%<%' AND price <> 'debt' AND tags IN ('[''a'']', '[''b'']') AND NOT ragged""",
    "rescued_rejects": f"""
        WITH {LOSSY},
        entries AS (
          SELECT *, 'price' AS field, price AS raw, 'not a double' AS reason, 1 AS nth FROM lossy WHERE price LIKE '<%' OR price = 'debt'
          UNION ALL SELECT *, 'tags', tags, 'not a list', 2 FROM lossy WHERE tags NOT IN ('[''a'']', '[''b'']')
          UNION ALL SELECT *, NULL, line, 'not as many fields as the header', 3 FROM lossy WHERE ragged)
        SELECT key, first_value(coalesce(field || ' is ', '') || reason) OVER (PARTITION BY kind, key ORDER BY nth) AS error_reason,
          field, raw, reason, kind FROM entries""",
    "arrival_order": """
        SELECT o_custkey, o_orderkey, o_orderpriority FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority LIKE '1%', CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE o_orderkey END, o_orderkey DESC) AS nth,
            bool_and(o_orderpriority LIKE '1%') OVER (PARTITION BY o_custkey) AS urgent FROM orders)
        WHERE nth = 1""",
    "results_store": _stored(),
    "append_review": MAPPED + """
        SELECT l_orderkey, run_id FROM g, (VALUES ('run-1'), ('run-2')) AS r(run_id) WHERE flag""",
    "curation_merge": MERGE_RUN,
    "curation_rejects": """
        SELECT doc_id, 'label_level_3 is not a list' AS error_reason FROM documents WHERE source = 'src4'""",
    "curation_results": f"""
        WITH run AS ({MERGE_RUN})
        {_union(
            "SELECT 'expect_column_values_to_not_be_null' AS rule, 'record_id' AS column, count(*) AS element_count, 0 AS unexpected_count, true AS success FROM run",
            "SELECT 'expect_column_proportion_of_unique_values_to_be_between' AS rule, 'record_id' AS column, count(*) AS element_count, count(*) - count(DISTINCT record_id) AS unexpected_count, true AS success FROM run",
            "SELECT 'expect_column_values_to_not_be_null' AS rule, 'url' AS column, count(*) AS element_count, 0 AS unexpected_count, true AS success FROM run",
            "SELECT 'expect_column_values_to_be_in_set' AS rule, 'isBiomimicry' AS column, count(*) AS element_count, 0 AS unexpected_count, true AS success FROM run",
            "SELECT 'expect_type_list' AS rule, 'level1' AS column, count(*) AS element_count, 0 AS unexpected_count, true AS success FROM run",
            "SELECT 'expect_non_empty_unique' AS rule, 'url' AS column, count(*) AS element_count, count(*) - count(DISTINCT url) AS unexpected_count, true AS success FROM run",
        )}""",
    "inbox_run": f"""
        WITH run AS ({MERGE_RUN})
        SELECT paper, url, doi, title, level1, level2, level3, venue_ids, venue_names, absolute_relevancy FROM run""",
    "inbox_run_stores": f"""
        WITH run AS ({MERGE_RUN}),
        batches AS (SELECT unnest([0, 1]) AS batch),
        taken AS (SELECT CASE WHEN lang IN ('en', 'fr') THEN 0 ELSE 1 END AS batch, * FROM documents),
        fresh AS (SELECT count(*) AS n FROM taken WHERE batch = 1 AND source <> 'src4' AND doc_id NOT IN (SELECT c_custkey FROM customer)),
        rules AS (SELECT unnest(['expect_column_values_to_not_be_null', 'expect_column_proportion_of_unique_values_to_be_between',
          'expect_column_values_to_be_in_set', 'expect_type_list', 'expect_non_empty_unique']) AS what)
        SELECT batch, 'label_level_3 is not a list' AS what, count(*) AS n FROM taken WHERE source = 'src4' GROUP BY batch
        UNION ALL
        SELECT batch, what, (SELECT count(*) FROM run) - CASE batch WHEN 0 THEN (SELECT n FROM fresh) ELSE 0 END AS n FROM batches, rules""",
    "curation_full": FULL_RUN,
    "curation_review": f"""
        WITH {POSTED}
        SELECT url, doi, '' AS label_level_1, '' AS label_level_2, '' AS label_level_3, '' AS title, '' AS abstract, '' AS venue_names,
          '' AS full_doc_link, '' AS is_open_access, 'Y' AS isBiomimicry, from1 AS ask_label_level_1, from2 AS ask_label_level_2,
          from3 AS ask_label_level_3 FROM q WHERE action = 'manual label'""",
}
