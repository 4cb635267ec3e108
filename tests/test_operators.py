import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import recordloom as rl
from conftest import values


def test_incremental_takes_only_this_month(spark, plan_of, tmp_path):
    rows = [
        (1, "A", dt.datetime(2024, 3, 1)),
        (2, "A", dt.datetime(2024, 3, 1, 0, 0, 1)),
        (3, "B", dt.datetime(2024, 3, 5)),
        (4, "A", dt.datetime(2024, 2, 29, 23, 59)),
        (5, "A", None),
    ]
    spark.createDataFrame(rows, "id int, kind string, at timestamp").write.parquet(str(tmp_path / "p"))
    df = rl.incremental_since_month_start(
        spark.read.parquet(str(tmp_path / "p")), "at", dt.datetime(2024, 3, 20), "kind", "A"
    )
    assert values(df, "id") == [(2,)]
    plan = plan_of(df)
    assert "GreaterThan(at," in plan and "EqualTo(kind,A)" in plan


def test_explode_references_fallback(spark):
    link = "struct<source_link: array<string>>"
    posts = spark.createDataFrame(
        [
            (1, (["a", "b"],), (["x"],)),
            (2, None, (["x"],)),
            (3, ([],), (["x"],)),
            (4, None, None),
            (5, (None,), (["x"],)),
        ],
        f"id int, reference_sources {link}, sources {link}",
    )
    got = values(rl.explode_references(posts, keep=["id"], position="pos"))
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, 0, "x"), (5, 0, "x")]  # an object without fields counts as none
    assert values(rl.explode_references(posts.drop("reference_sources"), keep=["id"]), "id") == [(1,), (2,), (3,), (5,)]


def test_fill_missing_and_conform(spark):
    df = spark.createDataFrame([(1, None, None, None)], "n int, t string, a array<string>, d double")
    assert rl.fill_missing(df).first().asDict() == {"n": 1, "t": "", "a": [], "d": None}
    from recordloom.schemas import RECORD_SCHEMA

    assert rl.conform(df, RECORD_SCHEMA).columns == RECORD_SCHEMA.names


def test_combine_counts_and_mixed_types(spark):
    a = spark.createDataFrame([(1, ["x", "y"])], "k int, tags array<string>")
    b = spark.createDataFrame([("['z']", 2.5), (None, None)], "tags string, extra double")
    both = rl.combine([a, b])
    assert both.count() == 3
    assert values(both.select(rl.parse_list_literal("tags"))) == [(["x", "y"],), (["z"],), ([],)]


def test_first_and_last_per_key(spark):
    rows = [("k", 2, "b"), ("k", 1, "a"), ("k", 3, "c"), ("m", None, "n"), ("m", 5, "e"), (None, 1, "z"), (None, 2, "y")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert values(rl.first_per_key(df, ["k"], ["o"]), "v") == [("a",), ("e",), ("z",)]
    assert values(rl.last_per_key(df, ["k"], ["o"]), "v") == [("c",), ("n",), ("y",)]


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_sequential_ids_are_contiguous_and_ordered(spark, rows):
    rng = random.Random(rows)
    data = [(i, rng.choice([1, 2, 3])) for i in range(rows)]
    df = spark.createDataFrame(data, "i long, o int").repartition(7)
    got = rl.assign_sequential_ids(df, "id", 101, ["o", "i"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(101, 101 + rows))
    assert [(r["i"], r["o"]) for r in got] == sorted(data, key=lambda r: (r[1], r[0]))


def test_fill_down_across_partitions(spark):
    from recordloom.operators.keys import fill_down

    rng = random.Random(5)
    rows = [(i, rng.choice([None] * 9 + ["x"]) and f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(9)
    got = {r["i"]: r["v"] for r in fill_down(df, {"v": F.col("v")}, ["i"]).collect()}
    last = None
    for i, v in rows:
        last = v or last
        assert got[i] == last


# Upsert -------------------------------------------------------------------------

MASTER = [(1, "a", 10), (2, "b", 20), (3, "c", None), (None, "loose", 0)]
UPDATES = [(1, "a1", 1, "x"), (1, "a2", 2, "y"), (3, None, 3, None), (9, "new", 4, "n"), (None, "none", 5, None), (9, "again", 6, "m")]


def brute_upsert(master, updates, repeated=False):
    """Row-by-row account of the merge, as a plain loop."""
    rows = [dict(zip(("k", "v", "n"), r), tag=None) for r in master]
    known = {r["k"] for r in rows if r["k"] is not None}
    inserts = []
    for k, v, o, tag in sorted(updates, key=lambda u: u[2]):
        if k in known:
            first = next(r for r in rows if r["k"] == k)
            first.update(v=v, tag=tag)
        else:
            inserts.append({"v": v, "n": None, "tag": tag})
    next_id = max(known, default=0) + 1
    for i, row in enumerate(inserts):
        rows.append({"k": next_id + i, **row})
    return sorted(((r["k"], r["v"], r["n"], r["tag"]) for r in rows), key=repr)


@pytest.mark.parametrize("broadcast_rows", [None, 2, 100])
def test_upsert_matches_a_plain_loop(spark, broadcast_rows):
    master = spark.createDataFrame(MASTER, "k long, v string, n int")
    updates = spark.createDataFrame(UPDATES, "k long, v string, o int, tag string")
    out = rl.upsert(master, updates, "k", ["o"], broadcast_rows=broadcast_rows)
    assert out.columns == ["k", "v", "n", "tag"]
    assert values(out) == brute_upsert(MASTER, UPDATES)


def test_upsert_repeated_master_changes_first_row_only(spark):
    rows = MASTER + [(1, "dup", 99)]
    master = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k long, v string, n int, at int")
    updates = spark.createDataFrame(UPDATES, "k long, v string, o int, tag string")
    out = rl.upsert(master, updates, "k", ["o"], master_order=["at"])
    assert values(out.select("k", "v", "n", "tag")) == brute_upsert(rows, UPDATES)


def test_upsert_random_against_a_plain_loop(spark):
    rng = random.Random(11)
    rows = [(rng.choice([None, *range(12)]), f"m{i}", i) for i in range(60)]
    new = [(rng.choice([None, *range(20)]), f"u{i}", i, rng.choice([None, "t"])) for i in range(80)]
    master = spark.createDataFrame([(*r, i % 7, i) for i, r in enumerate(rows)], "k long, v string, n int, a int, b int")
    updates = spark.createDataFrame(new, "k long, v string, o int, tag string")
    ranked = [r for _, r in sorted(enumerate(rows), key=lambda e: (e[0] % 7, e[0]))]
    out = rl.upsert(master, updates, "k", ["o"], master_order=["a", "b"])
    assert values(out.select("k", "v", "n", "tag")) == brute_upsert(ranked, new)


def test_upsert_keeps_old_values_on_request(spark):
    master = spark.createDataFrame(MASTER, "k long, v string, n int")
    updates = spark.createDataFrame([(3, None, 1)], "k long, v string, o int")
    assert (3, "c", None) in values(rl.upsert(master, updates, "k", ["o"], keep_old_if_null=True))
    assert (3, None, None) in values(rl.upsert(master, updates, "k", ["o"]))


def test_upsert_into_empty_master_and_twice(spark):
    master = spark.createDataFrame([], "k long, v string")
    updates = spark.createDataFrame([(None, "a", 1), (None, "b", 2)], "k long, v string, o int")
    once = rl.upsert(master, updates, "k", ["o"])
    assert values(once) == [(1, "a"), (2, "b")]
    again = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, o int")
    assert values(rl.upsert(once, again, "k", ["o"])) == [(1, "a"), (2, "b")]


# Taxonomy -----------------------------------------------------------------------

MAP = [
    ("Top", "Keepers", "KEEP", "Src", "Group", "Hold On"),
    ("Top", "Raised", "RAISE", None, None, "Let Go"),
    (None, None, "DELETE", None, "Other", "Drop"),
    (None, None, "MANUAL LABEL", None, None, "Ask"),
    ("Low", "Named, twice", "New, Name", "Src2", None, "Old"),
    (None, None, None, None, None, None),
    (None, None, "KEEP", None, "No key", None),
]
MAP_SCHEMA = "`Level I` string, `Level II` string, `Level III` string, `Alevel I` string, `Alevel II` string, `Alevel III` string"


@pytest.mark.parametrize("inline", [500, 0])
def test_map_labels(spark, inline):
    label_map = rl.load_label_map(spark.createDataFrame(MAP, MAP_SCHEMA))
    assert label_map.count() == 5
    df = spark.createDataFrame(
        [
            (1, ["Hold on", "LET GO"]),
            (2, ["drop"]),
            (3, ["ask", "old"]),
            (4, ["unknown", "hold on", "hold on"]),
            (5, []),
            (6, None),
            (7, ["hold on"]),
        ],
        "id int, labels array<string>",
    )
    out = rl.map_labels(df, "labels", label_map, inline_labels=inline).drop("labels").orderBy("id")
    assert [tuple(r) for r in out.collect()] == [
        (1, ["top"], ["keepers", "raised"], ["hold on"], ["src"], ["group"], ["hold on", "let go"], False, []),
        (2, [], [], [], [], ["other"], ["drop"], False, []),
        (3, ["low"], ["named, twice"], ["new, name"], ["src2"], [], ["ask", "old"], True, []),
        (4, ["top"], ["keepers"], ["hold on"], ["src"], ["group"], ["hold on"], False, ["unknown"]),
        (5, [], [], [], [], [], [], False, []),
        (6, [], [], [], [], [], [], False, []),
        (7, ["top"], ["keepers"], ["hold on"], ["src"], ["group"], ["hold on"], False, []),
    ]


def test_first_map_row_is_converted_and_parents_fill_down(spark):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(MAP)], f"nth int, {MAP_SCHEMA}")
    plain = values(rl.load_label_map(rows, order="nth"), "from3", "from1", "from2")
    filled = values(rl.load_label_map(rows, forward_fill=True, order="nth"), "from3", "from1", "from2")
    assert plain == [("ask", "", ""), ("drop", "", "other"), ("hold on", "src", "group"), ("let go", "", ""), ("old", "src2", "")]
    assert filled == [("ask", "src", "other"), ("drop", "src", "other"), ("hold on", "src", "group"), ("let go", "src", "group"), ("old", "src2", "")]


def test_convert_taxonomy_replaces_labels(spark):
    label_map = rl.load_label_map(spark.createDataFrame(MAP, MAP_SCHEMA))
    df = spark.createDataFrame([(["ignored"], ["ignored"], ["hold on"])], "label_level_1 array<string>, label_level_2 array<string>, label_level_3 array<string>")
    row = rl.convert_taxonomy(df, label_map).first()
    assert (row.label_level_1, row.label_level_2, row.label_level_3) == (["top"], ["keepers"], ["hold on"])
    assert (row.ask_label_level_1, row.ask_label_level_3, row.manual_label) == (["src"], ["hold on"], False)


def test_route_and_quarantine(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    auto, review = rl.route_by_flag(df, "flag")
    assert (values(auto), values(review)) == ([(2,), (3,)], [(1,)])
    good, rejects = rl.quarantine(df, {"is one": F.col("id") == 1, "flagged": F.col("flag")})
    assert values(good, "id") == [(2,), (3,)]
    assert values(rejects, "id", "error_reason") == [(1, "is one")]


# Enrichment ---------------------------------------------------------------------

BASE = "https://openalex.org/"


def some_works(spark):
    from recordloom.schemas import WORK_SCHEMA

    def work(i, doi, title, **more):
        fields = dict.fromkeys(WORK_SCHEMA.names)
        fields |= {"id": i, "doi": doi, "title": title, **more}
        return tuple(fields[n] for n in WORK_SCHEMA.names)

    return spark.createDataFrame(
        [
            work(BASE + "W1", "https://doi.org/10.1000/a", "one", abstract_inverted_index={"x": [0, 2]},
                 host_venue=(BASE + "V1", "Host"), alternate_host_venues=[(None, "Alt")],
                 authorships=[((BASE + "A1", "Ann"),)], referenced_works=[BASE + "W2"],
                 open_access=(True, "http://oa"), mesh=[("Term",)]),
            work(BASE + "W2", "https://doi.org/10.1000/a", "second with the same doi"),
            work(BASE + "W3", None, "no doi"),
            work("broken", "https://doi.org/10.1000/bad", "broken id"),
        ],
        WORK_SCHEMA,
    )


RECORDS = [
    (1, "", "10.1000/A", "u1", "['Own', 'Host']", "['L  x']"),
    (2, "W3", "10.1000/OTHER", "u2", "Plain", None),
    (3, "W3", "", "u3", None, ""),
    (4, "", "", "u4", "['V']", "['open"),
    (5, "", "10.1000/BAD", "u5", None, None),
    (6, "W9", "10.1000/A", "u6", None, None),
]
RECORD_TEXT = "record_id int, paper string, doi string, url string, venue_names string, label_level_1 string"


def test_enrich_by_id_or_doi(spark):
    records = spark.createDataFrame(RECORDS, RECORD_TEXT)
    out = rl.enrich_works(records, some_works(spark))
    assert values(out, "record_id", "work.title", "doi", "matched") == [
        (1, "one", "10.1000/A", True),
        (2, "no doi", "10.1000/OTHER", True),
        (3, None, "", False),
        (4, None, "", False),
        (5, "broken id", "10.1000/BAD", True),
        (6, None, "10.1000/A", False),
    ]
    loose = rl.enrich_works(records, some_works(spark), require_doi=False)
    assert (3, "no doi") in values(loose, "record_id", "work.title")


def test_to_record_and_its_rejects(spark):
    from recordloom.schemas import RECORD_SCHEMA

    records = spark.createDataFrame(RECORDS, RECORD_TEXT).withColumns({"title": F.lit("own"), "abstract": F.lit("text")})
    enriched = rl.enrich_works(records, some_works(spark))
    good, rejects = rl.quarantine(enriched, rl.record_checks(enriched))
    assert values(rejects, "record_id", "error_reason") == [
        (4, "label_level_1 is not a list"), (5, "work id without prefix")
    ]
    rows = {r["record_id"]: r.asDict() for r in rl.to_record(good).collect()}
    assert sorted(rows) == [1, 2, 3, 6]
    assert list(rows[1]) == RECORD_SCHEMA.names
    one = rows[1]
    assert (one["paper"], one["title"], one["abstract"], one["isOpenAccess"]) == ("W1", "one", "x - x", True)
    assert one["venue_names"] == ["Alt", "Host", "Own"] and one["venue_ids"] == ["V1"]
    assert one["author_ids"] == ["A1"] and one["reference_ids"] == ["W2"] and one["mesh_terms"] == ["Term"]
    assert one["level1"] == ["l__x"] and one["level2"] == [] and one["species"] == []
    assert rows[2]["venue_names"] == [] and rows[2]["abstract"] == ""
    three = rows[3]
    assert (three["title"], three["abstract"], three["isOpenAccess"], three["paper"]) == ("own", "text", None, "W3")


def test_fill_dois_keeps_known_and_unfound(spark):
    records = spark.createDataFrame(
        [(1, "u1", ""), (2, "u1", "10.1/own"), (3, "u2", None), (4, None, ""), (5, "u3", ""), (6, "u4", "")],
        "id int, url string, doi string",
    )
    pages = spark.createDataFrame(
        [
            ("u1", '<a href="https://doi.org/10.2%b">x</a>'),
            ("u1", '<a href="https://doi.org/10.2%a">x</a>'),
            ("u2", "nothing"),
            ("u3", '<a href="https://doi.org">x</a>'),
        ],
        "url string, html string",
    )
    out = rl.fill_dois(records, pages)
    assert out.columns == ["id", "url", "doi"]
    assert values(out, "id", "doi") == [(1, "10.2/a"), (2, "10.1/own"), (3, None), (4, ""), (5, ""), (6, "")]


@pytest.mark.parametrize("inline_labels", [0, 500])
def test_a_repeated_label_maps_alike_inline_and_joined(spark, inline_labels):
    names = ["to1", "to2", "action", "from1", "from2", "from3"]
    rows = [("m1", "m2", "keep", "", "", "x"), ("l1", "l2", "keep", "", "", "x"), ("n1", "n2", "keep", "", "", None)]
    label_map = spark.createDataFrame(rows, names)
    df = spark.createDataFrame([(1, ["X", None]), (2, []), (3, None), (4, ["y"])], "id int, labels array<string>")
    got = {r.id: r for r in rl.map_labels(df, "labels", label_map, inline_labels).collect()}
    assert got[1].level1 == ["l1"] and got[2].level1 == got[3].level1 == got[4].level1 == []
    assert got[4].unmatched_labels == ["y"] and got[2].unmatched_labels == []


def test_combine_takes_any_types(spark):
    frames = [spark.sql(q) for q in ("SELECT true AS a, 1 AS n", "SELECT 5 AS a, 2.5D AS n", "SELECT array(1, 2) AS a, 3L AS n")]
    out = rl.combine(frames)
    assert values(out, "a") == [("5",), ("[1,2]",), ("true",)] and values(out, "n") == [(1.0,), (2.5,), (3.0,)]
    with pytest.raises(ValueError):
        rl.combine([])


def test_new_order_columns_are_written_on_request(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(1, "c", 5), (None, "d", 6)], "k long, v string, updated_at int")
    assert rl.upsert(master, updates, "k", ["updated_at"]).columns == ["k", "v"]
    out = rl.upsert(master, updates, "k", ["updated_at"], write_order=True)
    assert values(out, "k", "v", "updated_at") == [(1, "c", 5), (2, "b", None), (3, "d", 6)]


def test_works_with_one_key_give_one_answer(spark):
    works = [("https://openalex.org/W1", "https://doi.org/10.1234/a", t) for t in ("old", "new")]
    records = spark.createDataFrame([(1, "W1", "10.1234/A")], "id int, paper string, doi string")
    found = []
    for rows in (works, works[::-1]):
        df = rl.enrich_works(records, spark.createDataFrame(rows, "id string, doi string, title string").coalesce(1))
        found.append(df.first().work.title)
    assert found == ["new", "new"]


def test_works_that_repeat_give_one_row_a_record(spark):
    """Whole repeats, works that share one key only, works under two keys, and keys nobody asks for."""
    prefix = "https://openalex.org/"
    fields = "id string, doi string, title string, mesh array<struct<descriptor_name:string>>"
    rows = [(prefix + "W1", "https://doi.org/10.1000/a", "one", None)] * 3
    rows += [(prefix + "W2", "https://doi.org/10.1000/a", "two", [("m",)]), (prefix + "W2", "https://doi.org/10.1000/b", "two again", None), (None, "https://doi.org/10.1000/c", None, None)]
    works = spark.createDataFrame(rows, fields)
    records = spark.createDataFrame(
        [(1, "W1", "10.1000/x"), (2, "W2", "10.1000/x"), (3, "", "10.1000/a"), (4, None, "10.1000/B"), (5, None, "10.1000/c"), (6, "W9", "10.1000/a"), (7, None, None), (7, None, None)],
        "n long, paper string, doi string",
    )
    got = values(rl.enrich_works(records, works), "n", "matched", "work.title")
    assert got == sorted(
        [(1, True, "one"), (2, True, "two"), (3, True, "one"), (4, True, "two again"), (5, True, None), (6, False, None), (7, False, None), (7, False, None)], key=repr
    )
    assert rl.works_by_key(works).count() == 5 and rl.works_by_key(works, wanted=spark.createDataFrame([("doi:10.1000/C",)] * 2, "k string")).count() == 1
