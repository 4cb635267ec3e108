"""Measures and searches of the llm operators against plain second implementations."""

import collections
import math
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from recordloom.llm import scoring
from recordloom.llm.common import BYTE_VALUES, prefix_sums, span_hashes
from recordloom.llm.context_mixing import ORDERS, SpellingModel
from recordloom.llm.pivots import near_vectors
from recordloom.llm.repetition import LENGTHS, repetition_rules
from recordloom.llm.spans import SENTENCES, WINDOW, WORDS, without_repeated_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_words(rng, n, size=400):
    return [f"{'éaüo'[int(x) % 4]}{x}" for x in rng.integers(0, size, n)]


def test_shares_of_repeated_words_and_lines_agree_with_counting(spark):
    rng = np.random.default_rng(41)
    rows = []
    for i in range(60):
        words = some_words(rng, int(rng.integers(0, 200)), 9 if i % 3 == 0 else 4000)
        said = some_words(rng, 12, 4000)
        if i % 4 == 1:
            words = words[:50] + said + words[50:] + said
        text = "".join(w + ("\n" if rng.random() < 0.2 else " \t"[i % 2]) for w in words)
        rows.append((i, text + ("\n" + text[:40]) * (i % 3)))
    rows += [(60, None), (61, ""), (62, " \n\n\t"), (63, "a\na\n\na"), (64, "x" * 5 + "\n" + "x" * 5), (65, " ".join(some_words(rng, 30000, 50)))]
    got = {r.doc_id: r for r in repetition_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        text = text or ""
        words = WORD.findall(text)
        total = sum(map(len, words))
        for n in LENGTHS:
            grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
            count = collections.Counter(grams)
            inside = {j for k, g in enumerate(grams) if count[g] > 1 for j in range(k, k + n)}
            assert math.isclose(got[i][f"share_{n}"], sum(len(words[j]) for j in inside) / max(1, total)), (i, n)
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += len(line) * (line in seen)
                seen.add(line)
        assert math.isclose(got[i].line_share, again / max(1, len(text))), i


def word_hash(word):
    data = np.frombuffer(word.translate(LOWER).encode(), dtype=np.uint8)
    return int(span_hashes(prefix_sums(BYTE_VALUES[data]), np.array([0]), np.array([len(data)]))[0])


def cuts_of(text):
    """Number of words, places behind which a sentence ends for good, and those where only a line ends."""
    found = list(WORD.finditer(text))
    n = len(found)
    stop = {k for k, m in enumerate(found) if m.group()[-1] in ".!?"}
    values = [0 if k in stop else word_hash(m.group()) for k, m in enumerate(found)]
    for k in range(n - WINDOW + 1):
        window = values[k : k + WINDOW]
        stop.add(k + max(j for j, v in enumerate(window) if v == min(window)))
    if n:
        stop.add(n - 1)
    lines = {k for k in range(n - 1) if "\n" in text[found[k].end() : found[k + 1].start()]} - stop
    return found, sorted(k + 1 for k in stop), sorted(k + 1 for k in lines)


def runs_of(ends):
    """The shortest runs of enough pieces and words from each piece forward and up to each backward, as word places."""
    begins = [0, *ends[:-1]] if ends else []
    out = set()
    for i in range(len(ends)):
        forward = [j for j in range(i + SENTENCES - 1, len(ends)) if ends[j] - begins[i] >= WORDS]
        backward = [j for j in range(i - SENTENCES + 1, -1, -1) if ends[i] - begins[j] >= WORDS]
        out |= {(begins[i], ends[forward[0]])} if forward else set()
        out |= {(begins[backward[0]], ends[i])} if backward else set()
    return out


def cleaned(rows):
    """Texts without the sentences of runs that an earlier place has, too, and how many these are."""
    places, parsed = collections.defaultdict(list), {}
    for doc, text in rows:
        found, fixed, lines = cuts_of(text)
        every = sorted({*fixed, *lines})
        lined = {(a, b) for a, b in runs_of(every) if a in lines or b in lines}
        parsed[doc] = (found, every, runs_of(fixed) | lined)
        for a, b in parsed[doc][2]:
            places[tuple(m.group().translate(LOWER) for m in found[a:b])].append((doc, a))
    out = {}
    for doc, text in rows:
        found, every, runs = parsed[doc]
        gone = set()
        for a, b in runs:
            if min(places[tuple(m.group().translate(LOWER) for m in found[a:b])]) != (doc, a):
                gone.update(range(a, b))
        kept, removed, begin = "", 0, 0
        for k, (a, b) in enumerate(zip([0, *every[:-1]], every)):
            end = found[b].start() if k + 1 < len(every) else len(text)
            if a in gone:
                removed += 1
            else:
                kept += text[begin:end]
            begin = end
        out[doc] = (kept if removed else text, removed, len([k for k in gone]))
    return out


def test_spans_agree_with_a_plain_search(spark):
    rng = np.random.default_rng(43)
    passages = [some_words(rng, int(n), 10**6) for n in (20, 30, 49, 51, 70, 120)]
    for p in passages[::2]:
        for k in range(8, len(p), 11):
            p[k] += ".!?"[k % 3]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(int(rng.integers(1, 4))):
            parts += some_words(rng, int(rng.integers(0, 60)), 10**6)
            if rng.random() < 0.7:
                said = list(passages[rng.integers(len(passages))])
                parts += [w.upper() for w in said] if rng.random() < 0.2 else said
        text = "".join(w + ("." if rng.random() < 0.06 else "") + ("\n" if rng.random() < 0.08 else "  "[: 1 + i % 2]) for w in parts)
        rows.append((i, text))
    rows += [(80, ""), (81, "one two"), (82, " ".join(passages[5] * 3)), (83, rows[3][1]), (84, " ".join(some_words(rng, 8000, 10**6) + passages[5]))]
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, _row int, _spans string, body int").repartition(5)
    got = without_repeated_spans(docs)
    assert got.columns == [*docs.columns, "n_sentences", "n_removed", "removed_words"]
    want = cleaned(rows)
    assert sum(w[1] > 0 for w in want.values()) > 20
    for r in got.collect():
        assert (r.text, r.n_removed, r.removed_words) == want[r.doc_id], r.doc_id


@pytest.mark.parametrize("size", [32, 128, 384])
def test_pivots_find_nine_of_ten_links_near_the_threshold(spark, size):
    """Pairs of a cosine between 0.931 and 0.95, planted among others; recall against all cosines."""
    rng = np.random.default_rng(size)
    rows = []
    for i in range(150):
        v = rng.normal(size=size)
        v /= np.linalg.norm(v)
        w = rng.normal(size=size)
        w -= (w @ v) * v
        cos = rng.uniform(0.931, 0.95)
        rows += [(2 * i, v), (2 * i + 1, cos * v + math.sqrt(1 - cos * cos) * w / np.linalg.norm(w))]
    vecs = spark.createDataFrame([(i, [float(x) for x in v], i % 4 // 2) for i, v in rows], "vec_id long, embedding array<double>, label int")
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    links = (unit @ unit.T >= 0.93) & ~np.eye(len(rows), dtype=bool)
    label = np.array([i % 4 // 2 for i, _ in rows])
    links &= label[:, None] == label[None, :]
    got = {r.vec_id: r.n_links for r in near_vectors(vecs).collect()}
    assert links.sum() >= 300 and all(got[i] <= links[i].sum() for i in range(len(rows)))
    assert sum(got.values()) >= 0.9 * links.sum()
    print("recall", size, sum(got.values()) / links.sum())


def test_scores_agree_with_a_slow_coder(spark, monkeypatch):
    """Every token once more, one by one, from the fitted models; and what the models spend on words sums to one at most."""
    used = {}

    def watched(name):
        plain = getattr(scoring, name)
        monkeypatch.setattr(scoring, name, lambda *args: used.setdefault(name, args) and plain(*args))

    for name in ("scored", "valued"):
        watched(name)
    rng = np.random.default_rng(47)
    texts = [" ".join(some_words(rng, int(rng.integers(0, 120)), 60)) for _ in range(40)]
    texts += [texts[3], "", None, "to be or not to be or not to be", "Neu NEU neu", " ".join(some_words(rng, 3000, 900))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in scoring.corpus_scores(docs).collect()}
    table, match, unseen, train, distinct = used["scored"]
    anchors, sizes, spelling = used["valued"]
    spelt = scoring.spelt_codes(spelling)
    lists = {i: [*(t or "").translate(LOWER).encode().split(), b""] for i, t in enumerate(texts)}
    count = collections.Counter(w for i, ws in lists.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    assert (train, distinct) == (sum(count.values()), len(count))

    def share(word):
        code = scoring.code_of(word, anchors)
        return math.log10(count[word] / sizes[code]) if count[word] else float(spelling.log10([word])[0]) - spelt[code]

    for i, tokens in lists.items():
        seen, total, tries, held, run = [], 0.0, 0, 0, 0
        for at, word in enumerate(tokens):
            code = scoring.code_of(word, anchors)
            a, b = ([scoring.NO_ANCHOR] * 2 + [c for c in seen if c < scoring.ANCHORS])[:-3:-1]
            source = max((j for j in range(at - 1) if tokens[j] == tokens[at - 1]), default=None) if at else None
            hit = source is not None and tokens[source + 1] == word
            if source is not None:
                rate, often = min(7, 8 * held // max(1, tries)), min(7, int(math.log2(1 + tries)))
                total += float(match[((min(run, 15) * 256 + seen[-1]) * 8 + rate) * 8 + often, int(hit)])
            if not hit:
                fresh = math.log10(unseen) - math.log10(max(1e-12, (10.0 ** table[a, b, scoring.ANCHORS + 1 :].astype(float)).sum()))
                total += share(word) + float(table[a, b, code]) + (math.log10(1 - unseen) if count[word] else fresh)
            tries, held, run = tries + (source is not None), held + hit, run + 1 if hit else 0
            seen.append(code)
        assert math.isclose(got[i], total, rel_tol=1e-5, abs_tol=1e-4), (i, got[i], total)
    for a, b in ((63, 63), (0, 63), (1, 0)):
        known = sum(10.0 ** (table[a, b, scoring.code_of(w, anchors)] + share(w)) for w in count)
        assert 0 < known <= 1 + 1e-4


def test_spelling_is_learnt_from_every_word(spark, monkeypatch):
    """More words than the mixer's weights were once fitted on; parts are learnt apart and averaged by the bits they have seen."""
    used = {}
    plain = scoring.valued
    monkeypatch.setattr(scoring, "valued", lambda *args: used.update(spelling=args[2]) or plain(*args))
    rng = np.random.default_rng(53)
    words = [f"{'éaüo'[k % 4]}{int(x):x}" for k, x in enumerate(rng.integers(0, 1 << 40, 27_000))]
    docs = spark.createDataFrame([(i, " ".join(words[i::60])) for i in range(60)], "doc_id long, text string")
    seen = {w for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2 for w in words[i::60]} | {""}
    assert len(seen) > 20_000
    scoring.corpus_scores(docs, part_words=9000)
    spelling = used["spelling"]
    rows = spark.createDataFrame([(bytearray(w.encode()),) for w in seen], "word binary").selectExpr("word", f"pmod(hash(word), {-(-len(seen) // 9000)}) AS part", "xxhash64(word) AS h")
    parts = collections.defaultdict(list)
    for r in rows.orderBy("part", "h", "word").collect():
        parts[r.part].append(bytes(r.word))
    learnt = [SpellingModel(spelling.zeros, spelling.ones).learn(p).mixer.learnt() for p in parts.values()]
    assert len(learnt) == 3
    total = sum(n for _, n in learnt)
    want = np.where(total > 0, sum(v * n for v, n in learnt) / np.maximum(1, total), SpellingModel(spelling.zeros, spelling.ones).mixer.learnt()[0])
    assert total[: len(ORDERS) * 40 : len(ORDERS)].sum() == sum(8 * (len(w.encode()) + 1) for w in seen)
    assert np.allclose(spelling.mixer.learnt()[0], want, rtol=1e-9, atol=1e-12)


def test_words_of_chunks_travel_packed(spark, monkeypatch):
    """The last shuffles and the stage tables of the scores, as a multiple of the texts."""
    paths = []
    plain = scoring.staged
    monkeypatch.setattr(scoring, "staged", lambda *args, **more: paths.append(plain(*args, **more)) or paths[-1])
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f: f.stat().st_size for at in local for f in Path(at).rglob("shuffle_*.data")}

    rng = np.random.default_rng(59)
    texts = [" ".join(f"{'éaüo'[int(x) % 4]}{int(x):x}" for x in 20_000 * rng.random(1500) ** 3) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = scoring.corpus_scores(docs)
    before = shuffled()
    assert len(scores.collect()) == len(texts)
    moved = sum(size for f, size in shuffled().items() if f not in before)
    stored = sum(Path(f.removeprefix("file:")).stat().st_size for df in paths for f in df.inputFiles())
    size = sum(len(t.encode()) for t in texts)
    print("disk", moved / size, stored / size)
    assert moved + stored < 1.25 * size


def test_packed_words_come_back(monkeypatch):
    """Whatever is packed at once, a chunk gets each of its words once, known ones with the share of their code."""
    monkeypatch.setattr(scoring, "GATHER_WORDS", 700)
    rng = np.random.default_rng(61)
    rows = {(int(c), int(n)) for c, n in zip(rng.integers(0, 3, 4000), rng.integers(0, 1 << 31, 4000) >> rng.integers(0, 31, 4000))}
    rows = [(c, n, int(rng.integers(0, 1 << 40)) >> int(rng.integers(0, 50)), int(rng.integers(0, 256)), float(np.float32(-rng.random()))) for c, n in rows]
    sizes = rng.integers(0, 1 << 41, 256)
    names = ["of", "number", "c", "code", "share"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.float32()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows[at : at + 300]), types)], names) for at in range(0, len(rows), 300)
    ]
    packs = pa.Table.from_batches(scoring.gathered(iter([batches[0].slice(0, 0), *batches])))
    assert packs.num_rows < 30 and not list(scoring.gathered(iter([batches[0].slice(0, 0)])))
    for chunk in range(3):
        got = scoring.spread(packs.filter(pc.equal(packs.column("of"), chunk)), sizes).to_pylist()
        want = {n: (c, code, share if c == 0 else math.log10(c / max(1, sizes[code]))) for of, n, c, code, share in rows if of == chunk}
        assert len(got) == len(want) and any(c == 0 for c, _, _ in want.values())
        for r in got:
            c, code, share = want[r["number"]]
            assert (r["c"], r["code"]) == (c, code) and math.isclose(r["share"], share, rel_tol=1e-6, abs_tol=1e-6)
