"""Scores by what follows the words of the corpus, against a slow coder."""

import collections
import math
import zlib

import numpy as np

from recordloom.llm import scoring

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START = object()


def learnt_from(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


class Follower:
    """What a predictor of one order knows of a text so far."""

    def __init__(self):
        self.run = self.tries = self.held = 0

    def cell(self, size, beside):
        rate, often = min(7, 8 * self.held // max(1, self.tries)), min(7, int(math.log2(1 + self.tries)))
        return ((min(self.run, 15) * size + beside) * 8 + rate) * 8 + often

    def see(self, has, comes):
        self.tries, self.held, self.run = self.tries + has, self.held + comes, self.run + 1 if comes else 0


def test_contexts_of_words_agree_with_a_slow_coder(spark, monkeypatch):
    """Every token once more, one by one, over several chunks; and what all known words cost sums to one at most."""
    used = {}

    def watched(name):
        plain = getattr(scoring, name)
        monkeypatch.setattr(scoring, name, lambda *args: used.setdefault(name, args) and plain(*args))

    for name in ("scored", "valued", "finished"):
        watched(name)
    # No new word looks like one that has been seen.
    monkeypatch.setattr(scoring, "CHECK_BITS", 60)
    rng = np.random.default_rng(67)
    words = [f"{'éaüo'[k % 4]}{k}" for k in range(400)]
    texts = [" ".join(words[int(k)] for k in 400 * rng.random(int(rng.integers(0, 150))) ** 3) for _ in range(60)]
    texts += [texts[3], texts[5].upper(), texts[8] + " " + texts[11], "", None, "to be or not to be or not to be", " ".join([texts[20]] * 4)]
    rows = [(i if i != 9 else None, t) for i, t in enumerate(texts)] + [(7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = scoring.corpus_scores(docs).collect()
    table, match, unseen, train, _ = used["scored"]
    anchors, sizes, spelling = used["valued"]
    follow = dict(zip(scoring.CONTEXTS, used["finished"][0]))
    spelt = scoring.spelt_codes(spelling)
    lists = [(i, [*(t or "").translate(LOWER).encode().split(), b""]) for i, t in rows]
    count = [collections.Counter() for _ in range(3)]
    for i, tokens in lists:
        if learnt_from(i):
            for at, word in enumerate(tokens):
                before = [START, START, *tokens[:at]][-2:]
                count[0][word] += 1
                count[1][before[1], word] += 1
                count[2][before[0], before[1], word] += 1
    assert train == sum(count[0].values())

    def cost(tokens, at, word, own, state, learn=True):
        """Logarithm of the probability of a word at a place of a text."""
        p2, p1 = [START, START, *tokens[:at]][-2:]
        after = {1: (count[0][p1] if at else count[0][b""]) - own, 2: count[1][p2, p1] - own if at else 0}
        times = {1: count[1][p1, word] - own, 2: count[2][p2, p1, word] - own}
        source = max((j for j in range(at - 1) if tokens[j] == tokens[at - 1]), default=None) if at else None
        hit = source is not None and tokens[source + 1] == word
        total, done = 0.0, False
        for order in (2, 1):
            comes = after[order] > 0 and times[order] > 0
            if not done and after[order] > 0:
                cell = state[order].cell(16, min(15, int(math.log2(after[order]))))
                total += float(follow[order][2 * cell + comes]) + (math.log10(times[order] / after[order]) if comes else 0)
            done |= comes
            if order == 2 and not done and source is not None:
                total += float(match[state[0].cell(256, scoring.code_of(tokens[at - 1], anchors)), int(hit)])
                done = hit
            if learn:
                state[order].see(after[order] > 0, comes)
        if learn:
            state[0].see(source is not None, hit)
        if not done:
            code = scoring.code_of(word, anchors)
            a, b = ([scoring.NO_ANCHOR] * 2 + [anchors[w] for w in tokens[:at] if w in anchors])[:-3:-1]
            total += float(table[a, b, code])
            if count[0][word]:
                total += math.log10(count[0][word] / sizes[code]) + math.log10(1 - unseen)
            else:
                total += float(spelling.log10([word])[0]) - spelt[code] + math.log10(unseen)
                total -= math.log10(max(1e-12, (10.0 ** table[a, b, scoring.ANCHORS + 1 :].astype(float)).sum()))
        return total

    want, sums = collections.defaultdict(list), []
    for n, (i, tokens) in enumerate(lists):
        own, state, total = int(learnt_from(i)), [Follower() for _ in range(3)], 0.0
        for at, word in enumerate(tokens):
            if not own and at % 40 == 7:
                sums.append(sum(10 ** cost(tokens, at, w, 0, state, learn=False) for w in count[0]))
            total += cost(tokens, at, word, own, state)
        want[i].append((total, max(1, len((rows[n][1] or "").encode()))))
    assert len(found) == len(rows) and len(sums) > 5 and all(0 < s <= 1 + 1e-3 for s in sums)
    for r in found:
        total, n_bytes = want[r.doc_id][0]
        assert math.isclose(r.context_score, total, rel_tol=1e-5, abs_tol=1e-4), (r.doc_id, r.context_score, total)
        assert math.isclose(r.bits_per_byte, -r.context_score * math.log2(10) / n_bytes, rel_tol=1e-9)


def test_texts_that_come_twice_are_told_apart(spark):
    """Each word is used in many texts; only what follows what tells a text that the corpus has again."""
    rng = np.random.default_rng(71)
    words = [f"{'éaüo'[k % 4]}{k}" for k in range(300)]
    texts = [" ".join(words[int(k)] for k in rng.integers(0, 300, 80)) for _ in range(150)]
    rows = [*enumerate(texts), *((1000 + i, texts[i]) for i in range(0, 150, 10))]
    got = {r.doc_id: r for r in scoring.corpus_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    twice = [got[d].bits_per_byte for i in range(0, 150, 10) for d, other in ((i, 1000 + i), (1000 + i, i)) if learnt_from(other)]
    once = [got[i].bits_per_byte for i in range(150) if i % 10]
    assert len(twice) > 20 and max(twice) < 0.5 * min(once)


def test_words_of_a_chunk_come_back_with_their_totals(spark):
    """Each file holds its words ahead of its texts; a text without them is refused."""
    docs = spark.createDataFrame([(i, f"a b c{i % 5} a b") for i in range(50)], "doc_id long, text string").coalesce(1)
    rows = docs.selectExpr("doc_id", "doc_id % 7 = 2 AS held_out", "CAST(text AS binary) AS body")
    kinds = "chunk long, doc_id long, held_out boolean, n_bytes long, ids binary, codes binary, word binary, number int, train long, hashes binary"
    batch = rows.mapInArrow(scoring.encoded, kinds).where("word IS NULL").toArrow().combine_chunks().to_batches()[0]
    (chunk, hashes, codes, texts), = scoring.by_chunk(iter([batch]))
    assert texts.num_rows == 50 and len(hashes) == len(codes) == 8
    parts = 3
    sent = [r for b in scoring.followers(parts, scoring.key_bits(300))(iter([batch.slice(0, 20), batch.slice(20)])) for r in b.to_pylist()]
    assert {r["part"] // parts for r in sent} == {0, 1, 2} and {r["of"] for r in sent} == {chunk}
    totals = [int(scoring.loosened(r["totals"], r["n"]).sum()) for r in sent]
    learnt = sum(i % 7 != 2 for i in range(50))
    assert sum(totals) == 3 * 6 * learnt
    try:
        list(scoring.by_chunk(iter([batch.slice(1)])))
    except ValueError:
        return
    raise AssertionError("texts without their words were taken")
