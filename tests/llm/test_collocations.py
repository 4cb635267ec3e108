"""Phrase collocations against brute force and on awkward tables."""

import collections
import re

import numpy as np
import pytest

from recordloom.llm.collocations import collocations, phrase_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top, covered=100):
    """Ranked phrases by counting every n-gram."""
    total, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    around = collections.Counter()
    for (lang, *w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                part = (lang, *w[i : i + m])
                around[part] = max(around[part], a)
    out = collections.defaultdict(list)
    for (lang, *w), a in found.items():
        if 100 * around[(lang, *w)] >= covered * a:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])], n))
    return {
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, some in out.items()
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(some)[:top], 1)
    }


@pytest.fixture(scope="module")
def texts():
    """Texts of a small vocabulary, so that many phrases recur; marks, tabs, line ends, cases, a null, an empty and a long one."""
    rng = np.random.default_rng(13)
    names = ["ka", "Ka", "ÉTÉ", "été", "no", "x-y", "🙂", "die", "0", "\x1c", "so"]
    share = np.array([9, 2, 3, 5, 6, 1, 1, 6, 2, 1, 4], dtype=float)
    ends = [" ", " ", " ", "\t", "  ", ", ", ".\n", "! ", "\r\n", "\x0b", "? ", ":", " ; "]

    def text(n):
        picked = rng.choice(len(names), n, p=share / share.sum())
        return "".join(names[i] + ends[rng.integers(0, len(ends))] for i in picked)

    rows = [(("en", "de", None, "und")[k % 4], text(int(rng.integers(0, 60)))) for k in range(60)]
    rows += [("de", "ein sehr langes Wort steht hier immer gleich. " * 40), ("en", text(6000)), ("en", None), (None, ""), ("fr", " .,; \n"), ("en", "new york city " * 30)]
    return rows + rows[:3]


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 5), (1, 40)])
def test_phrases_agree_with_counting_every_ngram(spark, texts, least, top):
    df = spark.createDataFrame([(i // 2 if i % 5 else None, t, lang, "w", 1) for i, (lang, t) in enumerate(texts)],
                               "doc_id long, text string, lang string, w1 string, n long").repartition(5)
    got = collocations(df, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(set(rows)) == len(rows) and set(rows) == expected(texts, least, top)


def test_covered_phrases_give_way_by_per_cent(spark, texts):
    df = spark.createDataFrame([(t, lang) for lang, t in texts], "text string, lang string")
    assert {tuple(r) for r in collocations(df, 3, 100, covered=60).collect()} == expected(texts, 3, 100, covered=60)


def test_the_number_of_words_counts_every_word(spark, texts):
    df = spark.createDataFrame([(t, lang) for lang, t in texts], "text string, lang string")
    totals = {r.lang: r.f for r in phrase_counts(df, 50).where("size(words) = 0").collect()}
    wanted = collections.Counter()
    for lang, t in texts:
        wanted["und" if lang is None else lang] += len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t or ""))
    assert totals == {k: v for k, v in wanted.items() if v}


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts are raised in the counted table itself: a n 1000 and l r pass 2 ** 63."""
    from unittest import mock

    big = [("en", [], "", 4 * 10**12), ("en", ["a"], "a", 3 * 10**11 + 7), ("en", ["b"], "b", 2 * 10**11 + 9), ("en", ["a", "b"], "a b", 10**11 + 1)]
    counts = spark.createDataFrame(big, "lang string, words array<string>, phrase string, f long")
    with mock.patch("recordloom.llm.collocations.phrase_counts", return_value=counts):
        got = collocations(spark.createDataFrame([], "text string, lang string")).first()
    assert got.score == 1000 * (10**11 + 1) * 4 * 10**12 // ((3 * 10**11 + 7) * (2 * 10**11 + 9))


def test_empty_tables_have_no_phrases(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string"), 1).count() == 0
