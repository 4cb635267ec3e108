"""Conversation repair against a plain search and on awkward tables."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from recordloom.llm.conversation_repair import ANY_END, cheapest, repair_reports, repaired, reports

NO_SPACE = re.compile(r"[^\x20\x09-\x0D]")


def legal(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        said = NO_SPACE.findall(text)
        out.append("b" if not said else "d" if (role, text) in seen else "." if said[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def best_plan(initials, faults):
    """The cheapest plan, least letters first, keeping the best one per state row by row."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    fresh = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                best[fresh[q]] = min(best.get(fresh[q], (c + 3, "Z")), (c + 2, a + "I"))
        return best

    best = {"": (0, "")}
    for i, f in zip(initials, faults):
        following = {}
        for q, (c, a) in with_inserts(best).items():
            moves = [(q, c + 3, a + "D")]
            if f not in "bd":
                moves += [(fresh[q], c + 2 + (f == "t"), a + "R")] + [(t, c + (f == "t"), a + "K") for k, t in after[q].items() if k == i]
            for t, cost, letters in moves:
                following[t] = min(following.get(t, (10**9, "")), (cost, letters))
        best = following
    return min(v for q, v in with_inserts(best).items() if q in ("", "a"))


def expected(rows):
    """Report of a conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = faults_of([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    cost, audit = best_plan(initials, faults)
    made, i, n = [], 0, sum(x != "D" for x in audit)
    for letter in audit:
        if letter != "D":
            fresh = "assistant" if (n - len(made)) % 2 else "user"
            made.append((rows[i][1] if letter == "K" else fresh, "" if letter == "I" else rows[i][2]))
        i += letter != "I"
    assert legal("".join(r[:1] for r, _ in made))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    count = collections.Counter(faults)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return gaps, count["b"], count["d"], count["t"], illegal, cost, audit, digest


def test_the_search_finds_the_cheapest_plan_with_the_least_letters():
    for n in range(5):
        for initials in itertools.product("suax", repeat=n):
            for faults in itertools.product(".tb", repeat=n) if n < 4 else ["." * n, "t.bd"]:
                got = cheapest("".join(initials), "".join(faults), 0, ANY_END)
                assert got == best_plan(initials, faults), (initials, faults)


@pytest.fixture(scope="module")
def conversations(spark):
    """Short ones of any faults, one of many segments, rows without conversation, turn, role or text, repeated rows."""
    rng = np.random.default_rng(12)
    roles, ends = ["user", "assistant", "system", "tool", "", None, "utter"], [".", "!", "?", "", " \n", "…", ".\t"]
    texts = ["Hi", "Ça va", "", " \t\r\n", None, "0", "🙂"]
    rows = []
    for conv in range(300):
        rows += [
            (conv, int(t), roles[rng.choice(7, p=[0.35, 0.35, 0.1, 0.05, 0.05, 0.05, 0.05])], None if (x := texts[rng.integers(7)]) is None else x + ends[rng.integers(7)])
            for t in rng.integers(-2, 9, rng.integers(1, 9))
        ]
    for t in range(500):
        rows.append((1000, t, "user" if t % 2 == 0 or t % 11 == 0 else "assistant", f"{'Yes' if t % 7 == 0 else t}{'.' if t % 5 else ''}"))
    rows += [(1001, k % 90, "user", "again.") for k in range(400)]
    rows += [(None, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(4)] + [(7, None, "assistant", "late."), (7, None, "user", "early."), (8, None, "u", "x")]
    rows += rows[:9]
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, conv string, pos int").repartition(7), rows


def test_repairs_of_all_conversations_agree_with_a_plain_search(spark, conversations):
    df, rows = conversations
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[" " if conv is None else str(conv)].append((turn, " " if role is None else role, " " if text is None else text))
    got = reports(repaired(df)).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len(got) == len(by_conv)
    for conv, *report in got:
        assert tuple(report) == expected(by_conv[conv]), conv
    assert any(len(v) > 400 for v in by_conv.values())


def test_repaired_turns_are_legal_and_keep_their_texts(conversations):
    df, rows = conversations
    turns = collections.defaultdict(list)
    kept = 0
    for r in sorted(repaired(df).collect(), key=lambda r: r.pos):
        turns[r.conv] += [m.role[:1] for m in r.made]
        kept += r.edit != "D"
        assert (r.edit == "D") == (r.text not in [m.text for m in r.made]) or r.text == ""
        assert r.fault not in "bd" or r.edit == "D"
    assert all(legal("".join(x)) for x in turns.values()) and kept > 200
    assert len(repaired(df).columns) == 10


def test_damaged_reports_agree_with_a_plain_search(conversations):
    df, rows = conversations
    by_conv = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by_conv[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in repair_reports(df).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: expected(some) if some else nothing for c, some in by_conv.items()}
    assert nothing in got.values()


def test_empty_tables(spark, conversations):
    none = spark.createDataFrame([], conversations[0].schema)
    assert repair_reports(none).count() == 0 and repaired(none).count() == 0
