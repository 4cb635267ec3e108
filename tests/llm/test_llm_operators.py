"""Operators of recordloom.llm against brute force and on awkward tables."""

import collections
import functools
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from recordloom.llm import near_dup, sharding
from recordloom.llm.bpe import Codec, Utf8Stream, bpe_round_trip, load_ranks
from recordloom.llm import components as graph
from recordloom.llm.common import staged, staged_by_bytes
from recordloom.llm.components import components
from recordloom.llm.context_mixing import CodeModel, SpellingModel, spelling_counts
from recordloom.llm.grouped import block_pairs, by_group, minority_pairs, spanning
from recordloom.llm.mixing import mixed
from recordloom.llm.near_dup import near_duplicates
from recordloom.llm.pivots import near_vectors
from recordloom.llm.preference import answered, paired, preference_pairs
from recordloom.llm.repetition import repetition_rules
from recordloom.llm.scoring import corpus_scores
from recordloom.llm.sharding import assign_shards
from recordloom.llm.spans import without_repeated_spans
from recordloom.llm.toxicity import fit_chain, flagged, labelled_sample, without_toxic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SYLLABLES = "ka to mi re su ne lo vi an er da po gu bé zü".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Texts with copies, near copies, repeated lines, a null, empties and a long one."""
    rng = np.random.default_rng(3)
    out = []
    for i in range(40):
        out.append(" ".join(w.capitalize() + "." if k % 6 == 5 else w for k, w in enumerate(words(rng, int(rng.integers(1, 120))))))
    base = words(rng, 200)
    for i in range(12):
        near = list(base)
        for k in rng.choice(200, i % 5, replace=False):
            near[k] = "x" + str(i)
        out.append(" ".join(near))
    line = " ".join(words(rng, 30)) + ".\n"
    out += [out[0], out[0].upper(), line * 4, "", None, "  \n\t ", "one", "ein zwei drei", " ".join(words(rng, 9000)), "ça \x00 🙂  \x1c end"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The texts under ids, one of them null, with columns whose names the operators use inside."""
    rows = [(i if i != 7 else None, t, f"s{i % 3}" if i % 5 else None, i, "x") for i, t in enumerate(texts)]
    rows.append(rows[3])
    schema = "doc_id long, text string, source string, size int, p string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def tokens_of(text):
    return WORD.findall(text or "")


def test_repetition_agrees_with_brute_force(docs):
    for r in repetition_rules(docs).join(docs.dropDuplicates(["doc_id"]), "doc_id").collect():
        w = tokens_of(r.text)
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        lines, again = set(), 0
        for line in (r.text or "").split("\n"):
            if tokens_of(line):
                again += line in lines
                lines.add(line)
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(inside), again)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_repetition_keeps_plain_and_rejects_repeated_text(docs, texts):
    kept = {r.doc_id: r.kept for r in repetition_rules(docs).collect()}
    assert kept[texts.index(next(t for t in texts if t and t.count("\n") == 4))] is False
    assert all(kept[i] for i in range(40, 52))


def test_repetition_rejects_texts_a_fifth_of_which_is_repeated(spark):
    rng = np.random.default_rng(31)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(10**9, 10**10, n))
    said, lines = fresh(25), [fresh(4) for _ in range(76)]
    scattered = lambda every: "\n".join(x for k, line in enumerate(lines) for x in ([line, lines[0]] if k % every == 1 else [line]))
    rows = [
        (0, " ".join([fresh(80), said, fresh(90), said])),  # 50 of 220 words
        (1, scattered(3)),  # 25 of 101 lines
        (2, " ".join([fresh(300), said, fresh(300), said])),  # 50 of 650 words
        (3, scattered(19)),  # 4 of 80 lines
    ]
    got = {r.doc_id: r for r in repetition_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 0.20 <= got[0].share_10 <= 0.25 and got[0].line_share == 0
    assert 0.20 <= got[1].line_share <= 0.25
    assert not got[0].base_failed and not got[1].base_failed and not got[0].kept and not got[1].kept
    assert got[2].kept and got[3].kept


def test_bpe_equals_tiktoken_and_decodes(docs):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})
    got = bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).join(docs.dropDuplicates(["doc_id"]), "doc_id").collect()
    assert len(got) >= 60
    for r in got:
        ids = plain.encode_ordinary(r.text or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_transducer_and_search_agree_on_odd_pieces():
    coder = Codec(RANKS, public_tokenizers.PATTERN)
    rng = np.random.default_rng(5)
    for n in (1, 3, 17, 200, 3000):
        piece = bytes(rng.integers(0, 256, n, dtype=np.uint8))
        assert coder.machine.encode(piece) == coder.machine.search(piece)
        assert b"".join(coder.machine.tokens[i] for i in coder.machine.encode(piece)) == piece
    assert coder.machine.encode(b"") == []


def test_decoder_gives_whole_characters_only():
    stream = Utf8Stream({i: bytes([i]) for i in range(256)})
    parts = [stream.feed(np.array([b])) for b in "aé漢🙂".encode()] + [stream.feed(np.array([], dtype=int), last=True)]
    assert [p for p in parts if p] == [c.encode() for c in "aé漢🙂"]
    assert stream.feed(np.array([0xF0, 0x9F])) == b"" and stream.feed(np.array([], dtype=int), last=True) == b"\xf0\x9f"


def shingles(text):
    w = tokens_of((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_agree_with_brute_force(docs, texts):
    sets = {i: shingles(t) for i, t in enumerate(texts) if i != 7}
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in sets:
        for j in sets:
            n = len(sets[i] & sets[j])
            if i < j and n and 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    rows = near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept and r.n_shingles == len(shingles(texts[7]))
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert len({find(i) for i in range(40, 52)}) < 12


def test_long_lists_are_compared_across_blocks(spark, monkeypatch):
    """Without the meeting with list firsts, and with small blocks, the forests alone connect a large group."""
    rng = np.random.default_rng(9)
    base = words(rng, 150)
    rows = []
    for i in range(70):
        near = list(base)
        for k in rng.choice(150, 1, replace=False):
            near[k] = f"y{i}"
        rows.append((i, " ".join(near)))
    rows += [(100 + i, " ".join(words(rng, 100))) for i in range(5)]
    monkeypatch.setattr(near_dup, "block_pairs", functools.partial(block_pairs, block=20))
    monkeypatch.setattr(near_dup, "first_pairs", lambda lists: lists.selectExpr("rep AS a", "rep AS b").limit(0))
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(70)) and all(got[100 + i] == 100 + i for i in range(5))


def test_links_hidden_behind_failed_pairs_are_found(spark):
    """Groups a half of whose pairs are above 85 per cent and half below, repeated ids, copies without an id."""
    rng = np.random.default_rng(23)
    rows, sets = [], []
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(200)]
        for _ in range(60):
            near = list(base)
            for at in rng.choice(190, int(rng.integers(1, 6)), replace=False) + 5:
                near[at] = f"x{rng.integers(1 << 40)}"
            rows.append((int(rng.integers(0, 150)), " ".join(near)))
    rows += [(None, rows[0][1]), (None, rows[5][1] + " more"), rows[7], (900, None), (900, ""), (900, "other text"), (900, rows[60][1].upper())]
    sets = [shingles(t) for _, t in rows]
    above = below = 0
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n) and n:
                above += 1
                group[find(i)] = find(j)
            else:
                below += n > 0
    assert above > 500 and below > 2 * above
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    want = collections.Counter((doc, least.get(find(i)), len(sets[i])) for i, (doc, _) in enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert collections.Counter((r.doc_id, r.component_id, r.n_shingles) for r in near_duplicates(docs).collect()) == want
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.selectExpr("doc_id", "text", "doc_id AS `group`", "text AS row", "1 AS k1"), "")
    got = [(r.doc_id, r.text) for r in kept.collect()]
    percent80 = list(range(len(rows)))
    group = percent80
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n) and n:
                group[find(i)] = find(j)
    parts = {find(i) for i in range(len(rows)) if sets[i]}
    assert len(got) == len(parts) + 2 and {find(rows.index(r)) for r in got if shingles(r[1])} == parts


def test_pairs_of_equal_bytes_are_left_to_lists_that_hold_both():
    """Posted coordinates that agree in their low byte only do not hand a pair to an earlier list."""
    rng = np.random.default_rng(4)
    sig = rng.integers(1, 1 << 31, near_dup.COORDINATES)
    for size in (2, 20):
        many = np.tile(sig, (size, 1))
        many[1:, :3] += 256
        many[2:] += rng.integers(1, 256, (max(0, size - 2), near_dup.COORDINATES))
        table = pa.table({
            "rep": pa.array(range(size), pa.int64()), "label": pa.array(range(size), pa.int64()), "key": pa.array([(5 << 32) | int(sig[5])] * size, pa.int64()),
            "posts": pa.array([0b100111] * size, pa.int64()), "whole": pa.array([m[[0, 1, 2, 5]].tolist() for m in many], pa.list_(pa.int32())),
            "low": pa.array([(m & 255).astype(np.uint8).tobytes() for m in many], pa.binary()), "need": pa.array([43] * size, pa.int32()),
            "own": pa.array([0] * size, pa.int32()), "i": pa.array([0] * size, pa.int32()), "j": pa.array([0] * size, pa.int32()),
        })
        got = list(by_group(near_dup.forest, near_dup._small(True))(table.to_batches()))
        assert [(r["a"], r["b"]) for b in got for r in b.to_pylist() if r["a"] == 0] == [(0, 1)]


def test_pipeline_links_near_copies_of_eighty_percent(spark):
    """Pairs with a similarity between 0.80 and 0.85 are one document in the stage, two in the query."""
    assert (near_dup.needed(80), near_dup.needed(85)) == (38, 43)
    rng = np.random.default_rng(17)
    rows = []
    for i in range(60):
        base = [f"w{x}" for x in rng.integers(0, 1 << 40, 204)]
        near = list(base)
        for at in (30, 80, 130, 180)[: 3 + i % 2]:
            near[at] = f"y{at}"
        # Of two hundred shingles a word in the middle changes five, one near the end one or two: 183 of 217 or 179 of 221.
        near[202 + i % 2] = "z"
        a, b = ({tuple(t[k : k + 5]) for k in range(200)} for t in (base, near))
        assert 0.80 <= len(a & b) / len(a | b) < 0.85
        rows += [(2 * i, " ".join(base), "s"), (2 * i + 1, " ".join(near), "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(0, 120, 2))
    assert all(r.kept for r in near_duplicates(docs).collect())


def test_pairs_of_long_texts_are_compared_a_bounded_lot_at_a_time(spark, monkeypatch):
    """However many pairs a batch holds, both texts of those compared at once stay within the bytes of a lot."""
    rng = np.random.default_rng(29)
    base = words(rng, 9000)
    bodies = []
    for i in range(12):
        near = list(base)
        near[700 * i] = f"y{i}"
        bodies.append(" ".join(near).encode())
    at = rng.integers(0, 12, (150, 2))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array([bodies[i] for i in at[:, 0]], pa.binary()), pa.array([bodies[i] for i in at[:, 1]], pa.binary())],
        ["a", "b", "body_a", "body_b"],
    )
    lots, plain = [], near_dup.shingle_sets
    monkeypatch.setattr(near_dup, "shingle_sets", lambda data, offsets, width: lots.append(len(data)) or plain(data, offsets, width))
    got = [r for b in near_dup.overlaps([batch.slice(0, 140), batch.slice(140)]) for r in b.to_pylist()]
    sets = [shingles(b.decode()) for b in bodies]
    assert [(r["a"], r["b"], r["shared"], r["total"]) for r in got] == [(i, j, len(sets[i] & sets[j]), len(sets[i] | sets[j])) for i, j in at]
    assert sum(lots) > 8 * 2**20 and max(a + b for a, b in zip(lots[::2], lots[1::2])) <= 2**20
    # Rows that are stored by bytes also come to Python in batches of few bytes, and the session is left as it was.
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    sizes = spark.range(0, 400, 1, 1).selectExpr("cast(repeat('x', 20000) AS binary) AS body").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long"
    )
    assert max(r.n for r in staged_by_bytes(sizes, "sizes").collect()) < 3 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_blocks_of_whole_sets_are_dealt_by_weight(spark):
    """Lists of heavy members fall into more blocks, and still each two members of different labels meet."""
    rows = [(1, i, int(i % 4 == 0) * i, 50) for i in range(80)] + [(2, i, i % 2, 1) for i in range(80)] + [(3, i, i, 10_000) for i in range(3)]
    dealt = minority_pairs(spark.createDataFrame(rows, "key long, rep long, label long, weight long"), "rep", 1000, block=60)
    assert "weight" not in dealt.columns
    groups = collections.defaultdict(list)
    for r in dealt.collect():
        groups[r.key, r.i, r.j].append(r)
    label = {(key, rep): name for key, rep, name, _ in rows}
    met = {(g[0], frozenset((x.rep, y.rep))) for g, many in groups.items() for x in many if x.minor for y in many if not y.minor and x.label != y.label}
    want = {(key, frozenset((a, b))) for key, a in label for also, b in label if key == also and a < b and label[key, a] != label[key, b]}
    assert met == want
    # Without weights list 1 has two blocks of sixty; by weight four, of about twenty members each.
    assert {i for key, i, _ in groups if key == 1} == set(range(4)) and {i for key, i, _ in groups if key == 2} == {0, 1}
    assert max(len([r for r in many if not r.minor]) for g, many in groups.items() if g[0] == 1) < 36


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame(chain + star + [(5, 5), (101, 100)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 7 for i in range(200, 260)}}
    assert components(links.limit(0)).count() == 0


def test_components_take_few_stages_whatever_the_paths_are(spark, monkeypatch):
    """Chains, hubs and repeated links by the plain rounds and by one lot, which needs no rounds."""
    rng = np.random.default_rng(17)
    pairs = [(i, i + 1) for i in range(1000, 1300)] + [(int(a), int(a) - int(d)) for a, d in zip(rng.integers(50, 600, 300), rng.integers(0, 9, 300))]
    pairs += [(700, i) for i in range(701, 760)] + pairs[:50] + [(b, a) for a, b in pairs[:50]]
    part = {}

    def find(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        part[max(x, y)] = min(x, y)
    want = {x: find(x) for x in part if find(x) != x}
    rng.shuffle(pairs)
    links = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long").repartition(4)
    stored = []
    monkeypatch.setattr(graph, "staged", lambda df, name: stored.append(name) or staged(df, name))
    for size in (100_000, 40):
        got = components(links, size=size).collect()
        assert len(got) == len(want) and {r.node: r.component for r in got} == want
        assert size < 100_000 or len(stored) <= 2


def test_spanning_edges_connect_what_weights_connect():
    weights = np.zeros((6, 6), dtype=np.uint8)
    for a, b, w in ((0, 1, 50), (1, 2, 60), (0, 2, 44), (3, 4, 64)):
        weights[a, b] = weights[b, a] = w
    edges = lambda labels: {tuple(sorted(e)) for e in spanning(weights, np.array(labels))}
    assert edges([0, 1, 2, 3, 4, 5]) == {(0, 1), (1, 2), (3, 4)}
    assert edges([0, 1, 0, 3, 4, 0]) == {(1, 2), (3, 4)}
    assert edges([0] * 6) == set()


def test_pivot_index_finds_all_links_of_near_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    rows = []
    for i in range(300):
        v = centres[i % 30] + rng.normal(scale=0.12, size=16)
        rows.append((i, [float(x) for x in v], i % 3))
    rows += [(300, rows[0][1], 0), (301, [2 * x for x in rows[0][1]], 0), (302, None, 0), (303, [0.0] * 16, 0), (304, rows[0][1], None)]
    rows += [(305, [float("nan")] + rows[0][1][1:], 0), (306, [None] + rows[0][1][1:], 0), (307, [], 0), (308, [1.0, 2.0], 0), (308, [1.0, 2.0], 0)]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    usable = [(i, np.array(v) / np.linalg.norm(v), lab) for i, v, lab in rows[:302]]
    want = {i: sum(a is not b and la == lb and float(a @ b) >= 0.93 for _, b, lb in usable) for i, a, la in usable}
    got = {r.vec_id: r for r in near_vectors(vecs).collect()}
    found = sum(got[i].n_links for i in want)
    assert found >= 0.9 * sum(want.values()) and all(got[i].n_links <= want[i] for i in want)
    assert got[300].component_id == got[301].component_id == got[0].component_id
    for i in range(302, 308):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[308].n_links == 1 and got[308].kept
    assert near_vectors(vecs.limit(0)).count() == 0


def test_spans_keep_one_copy_of_a_passage(spark):
    rng = np.random.default_rng(8)
    passage = ". ".join(" ".join(words(rng, 9)).capitalize() for _ in range(7)) + "."
    plain = [". ".join(" ".join(words(rng, 8)).capitalize() for _ in range(5)) + ". " for _ in range(6)]
    rows = [(i, plain[i] + passage + " " + plain[i][::-1].replace(".", "") + ".", i) for i in range(4)]
    rows += [(4, plain[4], 4), (5, None, 5), (6, "", 6), (7, "A. B. C.", 7), (8, "A. B. C.", 8), (9, passage + "\n" + plain[5] + "\n" + passage, 9)]
    got = {r.doc_id: r for r in without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string, n_removed int")).collect()}
    assert passage in got[0].text and got[0].n_removed == 0
    for i in (1, 2, 3):
        assert got[i].n_removed == 7 and got[i].removed_words == 63 and passage[20:60] not in got[i].text and plain[i].strip() in got[i].text
    assert got[4].text == plain[4] and got[5].text is None and got[6].text == "" and got[7].text == got[8].text == "A. B. C."
    assert got[9].n_removed == 14 and plain[5].strip() in got[9].text


def test_spans_find_passages_of_fifty_words_wherever_they_stand(spark):
    rng = np.random.default_rng(21)
    rows, want = [], {}
    for sentences in (1, 2, 3):
        for inside in (False, True):
            for broken in (False, True):
                for _ in range(5):
                    said = words(rng, 51)
                    for k in range(1, sentences + 1):
                        said[51 * k // sentences - 1] += "." if k < sentences or not inside else ""
                    around = [words(rng, int(rng.integers(5, 60))) for _ in range(4)]
                    if not inside:
                        around[0][-1], around[2][-1] = around[0][-1] + ".", around[2][-1] + "."
                    here = len(rows)
                    rows.append((here, " ".join(around[0] + said + around[1])))
                    rows.append((here + 1, " ".join([*around[2], ("\n" if broken else " ").join(said), *around[3]])))
                    want[here + 1] = 51 if not inside and not broken and sentences > 1 else 51 - 17
    got = {r.doc_id: r for r in without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        if i in want:
            assert want[i] <= got[i].removed_words <= 51, (i, got[i])
        else:
            assert got[i].text == text


def test_shards_have_equal_bytes_and_gapless_slots(docs, texts):
    rows = assign_shards(docs, shards=4).collect()
    assert len(rows) == len(texts) + 1
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        if r.doc_id is not None:
            body = (texts[r.doc_id] or "").encode()
            assert r.size == len(body) + 8 and r.text_crc32 == zlib.crc32(body)
    mean = sum(sizes.values()) / 4
    assert all(abs(sizes[s] - mean) <= max(r.size for r in rows) for s in range(4))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = assign_shards(docs, shards=4).collect()
    place = lambda rows: sorted((str(r.doc_id), r.shard, r.slot) for r in rows if r.doc_id not in (3, None))
    assert place(rows) == place(again)


def test_shards_stay_whole_when_the_rounds_end_before_the_overfull_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUNDS", 1)
    monkeypatch.setattr(sharding, "OVERSAMPLE", 2)
    rng = np.random.default_rng(18)
    hot = "x" * 90
    df = spark.createDataFrame([(i, hot if i % 3 == 0 else "y" * int(n)) for i, n in enumerate(rng.integers(0, 200, 4000))], "doc_id long, text string")
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in assign_shards(df).collect():
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(abs(b - sum(sizes.values()) / 24) <= 207 for b in sizes.values())


def test_mix_meets_targets_and_draws_disjoint_blocks(docs, texts):
    rows = mixed(docs).collect()
    assert len(rows) == len(texts) + 1 and rows[0].p == "x"
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len(tokens_of(r.text)) and len(r.draws) <= 3
        by[r.source].append(r)
    assert {s: v[0].source_size for s, v in by.items()} == {s: sum(r.size for r in v) for s, v in by.items()}
    assert math.isclose(sum(v[0].target for v in by.values()), sum(r.size for r in rows), rel_tol=1e-9)
    for v in by.values():
        assert v[0].target <= 3 * v[0].source_size + 1e-6
        assert abs(sum(r.size * len(r.draws) for r in v) - v[0].target) <= max(r.size for r in v)
    blocks = collections.defaultdict(set)
    for r in rows:
        for d in r.draws:
            blocks[r.source, d.block].add(d.shard)
    assert all(len(s) == 1 and None not in s for s in blocks.values())


def test_toxic_words_and_their_forms_are_found(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        w, bad = words(rng, int(rng.integers(5, 60))), i % 6 == 0
        if bad:
            w.insert(int(rng.integers(len(w))), "grunzk" + str(rng.choice(SYLLABLES)) if i % 12 else "Vexil!")
        rows.append((i, " ".join(w), "x"))
        if i % 3 == 0 or i % 7 == 0:
            labels.append((i, int(i % 2), int(bad)))
    labels += [(1, None, 1), (2, 0, None), (None, 1, 1)]
    rows += [(600, None, "x"), (601, "", "x"), (None, "to mi grunzkxyz re", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in flagged(docs, marks).collect()}
    unseen = [i for i in range(600) if not (i % 3 == 0 or i % 7 == 0)]
    assert sum(got[i] for i in range(0, 600, 6)) >= 98 and not any(got[i] for i in unseen)
    assert got[None] and not got[600] and not got[601]
    assert flagged(docs, marks.limit(0)).where("p[1] = 0.5").count() == len(rows)
    assert flagged(docs.limit(0), marks).count() == 0


def test_nothing_is_toxic_without_labelled_documents(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of some words", "en") for i in range(12)], "doc_id long, text string, lang string")
    kinds = {"none": [], "null": [(1, None, None), (2, 1, None)], "others": [(1000, 1, 1), (1001, 0, 0)]}
    for name, labels in kinds.items():
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = flagged(docs, spark.read.parquet(f"{tmp_path}/{name}/labels.parquet")).collect()
        assert len(rows) == 12 and not any(r.toxic for r in rows) and all(r.p == [0.5, 0.5] for r in rows)
        assert corpus_pipeline.drop_toxic(spark, docs, f"{tmp_path}/{name}").count() == 12


def test_chain_feeds_earlier_categories_to_later_models(spark):
    rng = np.random.default_rng(1)
    first = rng.random(400) < 0.5
    rows = [(i, [int(f)] * 2, [int(not f)]) for i, f in enumerate(first)]
    uses = np.array([[True, True], [False, False]])
    chain = fit_chain(spark.createDataFrame(rows, "doc_id long, y array<int>, found array<short>"), uses)
    assert chain[1][:2].tolist() == [0, 0] and chain[1][2] > 0.5


def test_chain_of_a_task_a_fold_equals_plain_regression(spark):
    """The models again, by dense matrices on the driver."""
    rng = np.random.default_rng(2)
    n, features = 90, 7
    x = (rng.random((n, features)) < 0.3).astype(float)
    y = np.column_stack([x[:, 0] + x[:, 1] > 0, (x[:, 2] + rng.random(n)) > 0.8]).astype(float)
    ids = rng.permutation(1000)[:n]
    rows = [(int(i), [int(v) for v in t], [int(k) for k in np.flatnonzero(f)]) for i, t, f in zip(ids, y, x)]
    uses = rng.random((2, features)) < 0.7

    def fit(x, y):
        w, mean, square = np.zeros(x.shape[1]), 0, 0
        for step in range(1, 201):
            slope = (1 / (1 + np.exp(-x @ w)) - y) @ x / len(y) + np.append(1e-5 * w[:-1], 0)
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
            w = w - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return w

    one = np.ones((n, 1))
    a = np.hstack([x * uses[0], one])
    out = np.zeros(n)
    for k in range(5):
        out[ids % 5 == k] = (a @ fit(a[ids % 5 != k], y[ids % 5 != k, 0]))[ids % 5 == k]
    odds = np.clip(out, np.log(0.001 / 0.999), np.log(0.999 / 0.001))
    want = [fit(a, y[:, 0]), fit(np.hstack([x * uses[1], odds[:, None], one]), y[:, 1])]
    got = fit_chain(spark.createDataFrame(rows, "doc_id long, y array<int>, found array<short>").repartition(4), uses)
    for w, v in zip(want, got):
        assert np.allclose(w, v, atol=1e-5)


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)] * 3 + [(5, "another")], "doc_id long, text string")
    labels = spark.range(50_100).selectExpr("IF(id < 100, id, id + 1000000) AS doc_id", "1 AS quality", "int(id % 2) AS toxic")
    got = labelled_sample(docs, labels, ("quality", "toxic"), 100).collect()
    assert sorted((r.doc_id, bytes(r.body), r.y) for r in got) == [(i, b"another" if i == 5 else f"text {i}".encode(), [1, i % 2]) for i in range(100)]
    assert labelled_sample(docs, labels, ("quality", "toxic"), 30).count() == 30


def test_toxic_documents_go_whatever_other_columns_are_called(spark):
    rows = [(i, "vexil " * (i % 4 == 0) + f"w{i} to mi re", i, f"b{i}", i % 2 == 0, i, "r") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int, body string, toxic boolean, p int, row string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {r for r in rows if r[0] % 4}
    assert flagged(docs, labels).columns == ["doc_id", "text", "y", "body", "row", "p", "toxic"]


def test_preference_pairs_share_the_prompt(spark):
    say = lambda c, *turns: [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows = say(0, ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"))
    rows += say(1, ("user", "a"), ("assistant", "b"), ("user", "x"))
    rows += say(2, ("user", "q"), ("assistant", None)) + say(3, ("user", "q"), ("assistant", None))
    rows += say(4, ("user", "alone")) + [(None, 0, "user", "z"), (0, None, "user", "z"), (0, 0, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair: r for r in preference_pairs(paired(turns)).collect()}
    assert set(got) == {0, 1}
    r = got[0]
    assert (r.n_shared, r.n_chosen, r.n_rejected) == (2, 2, 1)
    assert r.prompt == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert r.chosen == "<|user|>\nc<|end|>\n<|assistant|>\nd<|end|>\n" and r.rejected == "<|user|>\nx<|end|>\n"
    assert len(r.chosen_mask) == len(r.chosen) and "".join(c for c, m in zip(r.chosen, r.chosen_mask) if m == "1") == "d<|end|>\n"
    assert set(r.rejected_mask) == {"0"}
    assert got[1].n_shared == 2 and got[1].chosen == got[1].rejected == ""


def test_conversations_are_paired_with_their_neighbours_answers(spark):
    say = lambda c, *turns: [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows = say(0, ("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e"))
    rows += say(1, ("user", "q"), ("assistant", "r")) + say(2, ("user", "q"), ("assistant", "same")) + say(3, ("assistant", "same"))
    rows += say(4, ("user", "no answer")) + say(5, ("user", "q"), ("assistant", None)) + say(8, ("user", "q"), ("assistant", "alone"))
    rows += [(None, 0, "assistant", "z"), (0, None, "assistant", "z"), *rows[:2]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pair int, at string")
    got = {r.pair: r for r in preference_pairs(answered(df)).collect()}
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert set(got) == {0, 1, 2, 3, 5, 8}
    r = got[0]
    assert (r.n_shared, r.n_chosen, r.n_rejected) == (4, 1, 1)
    assert r.prompt == turn("system", "s") + turn("user", "a") + turn("assistant", "b") + turn("user", "c")
    assert (r.chosen, r.rejected) == (turn("assistant", "d"), turn("assistant", "r"))
    assert (got[1].prompt, got[1].chosen, got[1].rejected) == (turn("user", "q"), turn("assistant", "r"), turn("assistant", "d"))
    assert (got[2].n_shared, got[2].chosen, got[2].rejected) == (2, "", "") and got[3].prompt == turn("assistant", "same")
    assert (got[8].chosen, got[8].rejected, got[8].n_rejected) == (turn("assistant", "alone"), "", 0)
    assert preference_pairs(answered(df.limit(0))).count() == 0


def test_scores_count_exactly_and_beat_nothing_impossible(docs, texts):
    rows = corpus_scores(docs).collect()
    assert len(rows) == len(texts) + 1
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    all_rows = [(i if i != 7 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    lists = [(i, [*(t or "").translate(LOWER).encode().split(), b""]) for i, t in all_rows]
    count = collections.Counter(w for i, ws in lists if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    want = {i: sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws) for i, ws in lists}
    for r in rows:
        assert r.held_out == held(r.doc_id) and r.train_tokens == n and r.score < 0
        assert math.isclose(r.base_score, want[r.doc_id], rel_tol=1e-9)
    by_id = {i: ws for i, ws in lists}
    assert all((r.n_tokens, r.n_known) == (len(by_id[r.doc_id]), sum(count[w] > 0 for w in by_id[r.doc_id])) for r in rows)


def test_models_give_probabilities():
    rng = np.random.default_rng(0)
    counts = np.zeros((64, 64, 256))
    counts[rng.integers(0, 64, 500), rng.integers(0, 64, 500), rng.integers(0, 256, 500)] = 5
    total = (10.0 ** CodeModel(counts).log10()).sum(axis=2)
    assert np.allclose(total, 1, atol=1e-4)
    known = [b"abab", b"abba", b"baab"] * 50
    zeros, ones = spelling_counts(known)
    model = SpellingModel(zeros, ones).learn(known)
    odds = 10 ** model.log10([b"abab", b"baba", b"zz"])
    assert odds[0] > odds[2] and (10 ** model.log10([bytes([b]) for b in range(256)], 1)).sum() == pytest.approx(1, abs=0.05)


def test_empty_tables_give_empty_results(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for got in (
        repetition_rules(nothing), bpe_round_trip(nothing, RANKS, public_tokenizers.PATTERN), near_duplicates(nothing),
        without_repeated_spans(nothing), assign_shards(nothing), mixed(nothing), corpus_scores(nothing), flagged(nothing, labels),
    ):
        assert got.count() == 0


def test_pipeline_is_its_stages_one_after_the_other(spark, tmp_path):
    rng = np.random.default_rng(12)
    passage = ". ".join(" ".join(words(rng, 10)).capitalize() for _ in range(6)) + "."
    rows, labels = [], []
    for i in range(80):
        w = words(rng, 60)
        if i % 8 == 0:
            w.insert(30, "vexil")
        text = ". ".join(" ".join(w[k : k + 10]) for k in range(0, len(w), 10)) + "."
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, 1, int(i % 8 == 0)))
    rows += [(80, rows[1][1], "en", "s0", 1), (81, rows[2][1] + " zusatz", "en", "s1", 1)]
    rows += [(90 + k, passage + "\n" + ". ".join(" ".join(words(rng, 9)) for _ in range(20)) + ".", "en", "s3", 1) for k in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, at, str(tmp_path)).write.parquet(path)
        before, at = at, spark.read.parquet(path)
        seen[name] = at
        if name != "bpe":
            assert at.columns == before.columns
    clean = {r[0] for r in rows} - set(range(0, 80, 8))
    assert {r.doc_id for r in seen["toxicity"].collect()} == clean
    assert {r.doc_id for r in seen["near_dedup"].collect()} == clean - {80, 81}
    cut = {r.doc_id: r.text for r in seen["substring_dedup"].collect()}
    assert set(cut) == clean - {80, 81} and sum(passage in t for t in cut.values()) == 1
    drawn = collections.Counter(r.doc_id for r in seen["mixing"].collect())
    plan = {r.doc_id: len(r.draws) for r in mixed(seen["substring_dedup"]).collect() if r.draws}
    assert dict(drawn) == plan and max(plan.values()) <= 3
    final = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in df.collect())
    assert key(final) == key(seen["bpe"]) and len(key(final)) == sum(drawn.values())
    assert corpus_pipeline.ORACLE_SQL is None
