import random
import re

import pytest
from pyspark.sql import functions as F

import recordloom as rl


def one(spark, column, **cols):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in cols.items())
    df = spark.createDataFrame([tuple(v for _, v in cols.values())], schema)
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "text, doi",
    [
        ("see 10.1234/ab.c for", "10.1234/AB.C"),
        ("10.12345.6/x-y.", "10.12345.6/X-Y"),
        ("doi:10.1000/a'b", "10.1000/A"),
        ('"10.1000/q"', "10.1000/Q"),
        ("10.123/short", ""),
        ("x10.1234/glued", ""),
        ("", ""),
        (None, ""),
        ("a 10.1234/one 10.5678/two", "10.1234/ONE"),
    ],
)
def test_extract_doi(spark, text, doi):
    assert one(spark, rl.extract_doi("c"), c=("string", text)) == doi


def test_doi_from_url_keeps_case(spark):
    assert one(spark, rl.doi_from_url("c"), c=("string", "http://x.org/doi/10.1111/j.Ab/full")) == "10.1111/j.Ab/full"
    assert one(spark, rl.doi_from_url("c"), c=("string", "http://x.org/")) == ""


@pytest.mark.parametrize(
    "url, html, doi",
    [
        ("u", '<a href="https://doi.org/10.1/A">x</a><a href="https://doi.org/10.1/B">y</a>', "10.1/A"),
        ("u", "<A class=q HREF='http://dx.doi.org/10.1/s'>x</A>", "10.1/s"),
        ("u", "<a href=http://doi.org/10.1/u>x</a>", "10.1/u"),
        ("u/10.1234/z", '<a href="https://doi.org">x</a>', ""),
        ("u/10.1234/z", '<a href="https://doi.org/">x</a>', "10.1234/z"),
        ("u/10.1234/z", '<a href="/other">x</a> doi.org in text', "10.1234/z"),
        ("u/10.1234/z", "", "10.1234/z"),
        ("u", '<!-- <a href="https://doi.org/10.1/hidden">x</a> --><a href="https://doi.org/10.1/v">y</a>', "10.1/v"),
        ("u", '<a href="https://doi.org/10.1/a&amp;b">x</a>', "10.1/a&b"),
        ("u", '<a href="https://doi.org/10.1/a?u=doi.org/x">x</a>', "10.1/a?u="),
        ("u", "nothing", ""),
        (None, None, ""),
    ],
)
def test_doi_from_pages(spark, url, html, doi):
    pages = spark.createDataFrame([(url, html)], "url string, html string")
    assert rl.doi_from_pages(pages).first()["doi"] == doi


def test_extract_work_id(spark):
    assert one(spark, rl.extract_work_id("c"), c=("string", "https://openalex.org/W12")) == "W12"
    assert one(spark, rl.extract_work_id("c"), c=("string", None)) == ""
    assert one(spark, rl.extract_work_id("c"), c=("string", "W12")) is None
    assert one(spark, rl.bad_work_id("c"), c=("string", "W12")) is True
    assert one(spark, rl.bad_work_id("c"), c=("string", None)) is False


@pytest.mark.parametrize(
    "text, key",
    [("12", 12), ("12.0", 12), ("12.9", 12), ("", None), ("x", None), (None, None),
     ("9007199254740993", 9007199254740993), ("nan", None)],
)
def test_to_key(spark, text, key):
    assert one(spark, rl.to_key("c"), c=("string", text)) == key


def test_lists(spark):
    text = ("string", "['a', \"b's\", 'C']")
    assert one(spark, rl.parse_list_literal("c"), c=text) == ["a", "b's", "C"]
    assert one(spark, rl.parse_list_literal("c"), c=("string", r"['it\'s']")) == ["it's"]
    assert one(spark, rl.parse_list_literal("c", "double"), c=("string", "[0.5, 1]")) == [0.5, 1.0]
    assert one(spark, rl.parse_list_literal("c"), c=("string", None)) == []
    assert one(spark, rl.bad_list_literal("c"), c=("string", "['a'")) is True
    assert one(spark, rl.bad_list_literal("c"), c=("string", "")) is False
    paths = ("array<string>", ["a > b > c", "d > e"])
    assert one(spark, rl.path_level("c", 1), c=paths) == ["b", "e"]
    assert one(spark, rl.path_level("c", 2), c=paths) == ["c"]  # a shorter path has no such part
    assert one(spark, rl.path_level("c", 0), c=("array<string>", None)) == []
    assert one(spark, rl.clean_labels("c"), c=("array<string>", ["Move  on\tX"])) == ["move__on_x"]
    assert one(
        spark, rl.append_missing("a", "b"), a=("array<string>", ["x", "y"]), b=("array<string>", ["z", "y", "z"])
    ) == ["x", "y", "z", "z"]
    assert one(spark, rl.append_missing("a", "b"), a=("array<string>", None), b=("array<string>", ["z"])) == ["z"]
    assert one(spark, rl.subset_of("c", ["a", "b"]), c=("array<string>", [])) is True
    assert one(spark, rl.subset_of("c", ["a", "b"]), c=("array<string>", ["a", "q"])) is False


def test_venues_and_authors(spark):
    venue = "struct<id: string, display_name: string>"
    base = "https://openalex.org/"
    schema = f"host {venue}, alt array<{venue}>, auth array<struct<author: {venue}>>"
    df = spark.createDataFrame(
        [
            ((base + "V1", "Host"), [(base + "V2", None), (None, "Alt"), ("", "")], [((base + "A1", "Ann"),), ((None, "Bo"),)]),
            (None, [(base + "V2", "Alt")], None),
            ((None, "H"), None, []),
        ],
        schema,
    )
    ids, names = rl.venue_lists("host", "alt")
    aids, anames = rl.author_lists("auth")
    got = [tuple(r) for r in df.select(ids, names, aids, anames).collect()]
    assert got == [
        ([base + "V2", "V1"], ["Alt", "Host"], ["A1", ""], ["Ann", "Bo"]),
        ([], [], [], []),
        ([""], ["H"], [], []),
    ]


def test_rebuild_text(spark):
    kind = "map<string,array<int>>"
    assert one(spark, rl.rebuild_text("c"), c=(kind, {"b": [1, 3], "a": [0]})) == "a b - b"
    assert one(spark, rl.rebuild_text("c"), c=(kind, {"z": [2]})) == "- - z"
    assert one(spark, rl.rebuild_text("c"), c=(kind, {})) == ""
    assert one(spark, rl.rebuild_text("c"), c=(kind, None)) == ""
    assert one(spark, rl.max_position("c"), c=(kind, {"b": [1, 3], "a": [0]})) == 3
    df = spark.sql("select map_from_arrays(array('x','y'), array(array(0,1), array(1))) as c")
    assert df.select(rl.rebuild_text("c")).first()[0] == "x y"


def test_rebuild_inverts_invert(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.randint(1, 400))) for _ in range(30)]
    texts.append(" ".join(f"w{rng.randint(0, 5000)}" for _ in range(20_000)))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select("t", rl.rebuild_text(rl.invert_text(F.split("t", " "))).alias("b"))
    assert back.filter("t <> b or b is null").count() == 0


def test_doi_search_agrees_with_a_plain_regex(spark):
    # Fixed value: the DOI form, here with a look-ahead.
    pattern = re.compile(r"""\b(10[.][0-9]{4,}(?:[.][0-9]+)*/(?:(?!["&'<>])\S)+)\b""")
    rng = random.Random(3)
    bits = ["10.", "1000", "12345", ".7", "/", "a", "B", "\u00e9", "_", "-", " ", "\u00a0", "\t", "<", ">", '"', "'", "&", ".", "(", ")", "doi:", "\u4e2d"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["10.1000/" + "".join(rng.choice(bits) for _ in range(8)) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["d"] for r in df.select("i", rl.extract_doi("t").alias("d")).collect()}
    for i, text in enumerate(texts):
        found = pattern.search(text)
        assert got[i] == (found.group().upper() if found else ""), repr(text)


def test_rebuild_agrees_with_a_plain_loop(spark):
    rng = random.Random(4)
    rows = []
    for n in range(300):
        words = [f"w{k}" for k in range(rng.randint(1, 12))]
        rows.append((n, [(w, sorted(rng.sample(range(40), rng.randint(1, 5)))) for w in words]))
    df = spark.createDataFrame(rows, "n int, e array<struct<key: string, value: array<int>>>")
    out = df.select("n", rl.rebuild_text(F.map_from_entries("e")).alias("t"))
    got = {r["n"]: r["t"] for r in out.collect()}
    for n, entries in rows:
        slots = ["-"] * (max(p for _, ps in entries for p in ps) + 1)
        for word, places in entries:
            for p in places:
                slots[p] = word
        assert got[n] == " ".join(slots)
