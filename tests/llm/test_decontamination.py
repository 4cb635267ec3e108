"""Benchmark decontamination against brute force and on awkward tables, by broadcast and by join."""

import re

import numpy as np
import pytest

from recordloom.llm.decontamination import decontaminated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(text, items):
    """Words, hit words, items and the text without hits, by comparing every window."""
    w = words(text)
    hit, found = set(), set()
    for name, item in items:
        v = words(item)
        n = min(10, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(name)
    spans = [m.span() for m in WORD.finditer((text or "").translate(LOWER))]
    rest, last = "", 0
    for k in sorted(hit):
        begin, end = spans[k]
        if k - 1 not in hit:
            rest += (text or "")[last:begin]
        last = end
    return len(w), len(hit), sorted(str(f) for f in found if f is not None), None if text is None else rest + text[last:]


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(11)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    items = [(i, fresh(int(n))) for i, n in enumerate([25, 10, 11, 40, 9, 3, 1, 12])]
    items += [(8, "Ça va, bien? Été_2024"), (9, None), (10, " ;, "), (3, items[3][1]), (3, fresh(14)), (None, fresh(12)), (11, items[0][1]), (12, "hot " * 12)]
    texts = [fresh(30), None, "", "  ;; ", items[0][1].upper(), fresh(5) + " " + items[0][1] + "! " + fresh(5)]
    texts += [items[3][1].replace(" ", ",\n"), fresh(4) + " " + " ".join(items[3][1].split()[7:20]) + "; " + fresh(3), " ".join(items[3][1].split()[:9])]
    texts += [f"{items[4][1]} and {items[6][1]} - {items[5][1]}", "x ça VA\tbien été 2024 y", "ÇA va bien été 2024", items[13][1], "Hot! " * 40]
    texts += [" ".join(items[k][1] for k in (0, 1, 2, 3, 7)), fresh(20000) + " " + items[7][1] + " " + fresh(20000)]
    rows = [(i if i != 2 else None, t, f"k{i}", 7, 1, "s") for i, t in enumerate(texts)]
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, n_words int, at int, words string").repartition(3)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, item string")
    return docs, benchmark, items


@pytest.mark.parametrize("most", [500_000, 0])
def test_hits_agree_with_comparing_every_window(tables, most):
    docs, benchmark, items = tables
    whole = {r["_key"]: r.text for r in docs.collect()}
    got = decontaminated(docs, benchmark, broadcast_windows=most)
    assert got.columns == ["doc_id", "text", "_key", "at", "words", "n_words", "n_hit", "items"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.n_hit, r["items"], r.text) == expected(whole[r["_key"]], items), r["_key"]
    assert sum(r.n_hit > 0 for r in rows) > 8


def test_documents_are_dropped_or_only_reported(tables):
    docs, benchmark, items = tables
    clean = {r["_key"] for r in docs.collect() if not expected(r.text, items)[1]}
    assert {r["_key"] for r in decontaminated(docs, benchmark, "documents").collect()} == clean
    assert {(r["_key"], r.text) for r in decontaminated(docs, benchmark, "nothing").collect()} == {(r["_key"], r.text) for r in docs.collect()}
    with pytest.raises(ValueError):
        decontaminated(docs, benchmark, "all")


@pytest.mark.parametrize("most", [500_000, -1])
def test_empty_tables(spark, tables, most):
    docs, benchmark, _ = tables
    none = spark.createDataFrame([], benchmark.schema)
    assert {(r.n_hit, tuple(r["items"])) for r in decontaminated(docs, none, broadcast_windows=most).collect()} == {(0, ())}
    assert decontaminated(spark.createDataFrame([], docs.schema), benchmark, broadcast_windows=most).count() == 0
