"""Repair of conversations: the cheapest edits that give them a legal course.

The roles of a legal conversation begin with at most one system turn, then user
and assistant turns follow each other, ending with the assistant; without any
turn it is legal, too. Rows are kept, given another role, deleted, or new turns
are inserted; the plan of least cost is found by iterative deepening A*: a
depth-first search that tries edits in the order of their letters under a
growing bound, with a table of states that failed. What it finds first is the
cheapest plan and, of equal ones, the one whose letters come first.

A conversation may hold any share of all rows, so rows are sorted by range, not
by conversation, and cut into segments of ``SEGMENT`` rows. For a conversation
of several segments the search runs once for each state a segment may begin and
end in, on many tasks; the chain of a conversation then picks the states. A
segment ends with an edit of a row (only the last one may insert turns behind
it), hence no plan of a segment begins another one and the choice segment by
segment is the choice over the whole. All of a chain that meets in one task are
forty small numbers for every 64 rows, two to three times the letters of the
plan, which is one value of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import small_batches, staged

# Rows of a segment: a power of two, so that segments follow from row numbers.
SEGMENT_BITS = 6
SEGMENT = 1 << SEGMENT_BITS

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, CUT_COST = 3, 2, 2, 1
# Faults of a row.
BLANK, DUPLICATE, CUT, FINE = "b", "d", "t", "."
# States: before any turn, after system, user and assistant; ANY_END ends a conversation.
BEGIN, SYSTEM, USER, ASSISTANT, ANY_END = range(5)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE = (USER, USER, ASSISTANT, USER)
LEGAL_PAIRS = ("su", "ua", "au")


def gone(fault: str) -> bool:
    """Whether a row has to be deleted."""
    return fault in (BLANK, DUPLICATE)


@lru_cache(1 << 14)
def cheapest(initials: str, faults: str, start: int, goal: int) -> tuple[int, str] | None:
    """Cost and letters of the best plan from state ``start`` to ``goal``; None if there is none."""
    n = len(initials)
    if goal == BEGIN and start != BEGIN or goal == SYSTEM and start not in (BEGIN, SYSTEM):
        return None
    if goal == SYSTEM and start == BEGIN and not any(i == "s" and not gone(f) for i, f in zip(initials, faults)):
        return None
    # What no plan can avoid paying from a row on.
    due = [0] * (n + 1)
    for i in reversed(range(n)):
        due[i] = due[i + 1] + (DELETE_COST if gone(faults[i]) else CUT_COST * (faults[i] == CUT))
    failed: dict[tuple[int, int], int] = {}
    letters: list[str] = []

    def reached(i: int, state: int, left: int) -> bool:
        """Whether the goal can be reached from row ``i`` for ``left`` at most."""
        if left < due[i] or failed.get((i, state), -1) >= left:
            return False
        if i == n and (state in (BEGIN, ASSISTANT) if goal == ANY_END else state == goal):
            return True
        for letter, row, following, cost in edits(i, state):
            letters.append(letter)
            if reached(row, following, left - cost):
                return True
            letters.pop()
        failed[i, state] = left
        return False

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield DELETE, i + 1, state, DELETE_COST
        if i < n or goal == ANY_END:
            yield INSERT, i, MADE[state], INSERT_COST
        if i < n and not gone(faults[i]):
            extra = CUT_COST * (faults[i] == CUT)
            if (state, initials[i]) in KEPT:
                yield KEEP, i + 1, KEPT[state, initials[i]], extra
            yield REROLE, i + 1, MADE[state], REROLE_COST + extra

    bound = due[0]
    while not reached(0, start, bound):
        bound += 1
    return bound, "".join(letters)


def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plans of each segment: all it may need if its conversation has several, else the one.

    ``costs`` and ``ranks`` (by letters, among the plans from one state) go by
    ``start * 5 + goal``, -1 where no plan is.
    """
    for batch in batches:
        plans, costs, ranks = [], [], []
        for initials, faults, several in zip(*(batch.column(c).to_pylist() for c in ("initials", "faults", "several"))):
            wanted = [(s, g) for s in range(4) for g in range(5)] if several else [(BEGIN, ANY_END)]
            found = {(s, g): cheapest(initials, faults, s, g) for s, g in wanted}
            of = lambda s, g: found.get((s, g))  # noqa: B023, E731
            order = {s: sorted(of(s, g)[1] for g in range(5) if of(s, g)) for s in range(4)}
            every = [of(s, g) for s in range(4) for g in range(5)]
            plans.append([p[1] if p else None for p in every])
            costs.append([p[0] if p else -1 for p in every])
            ranks.append([order[k // 5].index(p[1]) if p else -1 for k, p in enumerate(every)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"), batch.column("segment"), batch.column("several"), batch.column("first"), pa.array(plans, pa.list_(pa.string())),
                pa.array(costs, pa.list_(pa.int32())), pa.array(ranks, pa.list_(pa.int32())),
            ],
            ["conv", "segment", "several", "first", "plans", "costs", "ranks"],
        )


def best_chain(costs: list[list[int]], ranks: list[list[int]]) -> list[tuple[int, int]]:
    """States at the begin and end of each segment of a conversation."""
    last = len(costs) - 1
    goals = [range(4)] * last + [(ANY_END,)]
    rest = [dict.fromkeys(range(5), 0)]
    for k in range(last, -1, -1):
        after, here = rest[-1], {}
        for s in range(4):
            sums = [costs[k][s * 5 + g] + after[g] for g in goals[k] if costs[k][s * 5 + g] >= 0 and g in after]
            if sums:
                here[s] = min(sums)
        rest.append(here)
    rest.reverse()
    state, chosen = BEGIN, []
    for k in range(last + 1):
        open_goals = [
            g for g in goals[k] if costs[k][state * 5 + g] >= 0 and g in rest[k + 1] and costs[k][state * 5 + g] + rest[k + 1][g] == rest[k][state]
        ]
        goal = min(open_goals, key=lambda g: ranks[k][state * 5 + g])  # noqa: B023
        chosen.append((state, goal))
        state = goal
    return chosen


def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[str, int, int, int]] = []
        for conv, chain in zip(batch.column("conv").to_pylist(), batch.column("chain").to_pylist()):
            states = best_chain([c["costs"] for c in chain], [c["ranks"] for c in chain])
            out += [(conv, c["segment"], s, s * 5 + g) for c, (s, g) in zip(chain, states)]
        names = ["conv", "segment", "start", "pick"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)


def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edit of each row: letter, new role if it gets one, roles of turns inserted before and behind it."""
    for batch in batches:
        out: list[tuple] = []
        for first, start, plan, initials in zip(*(batch.column(c).to_pylist() for c in ("first", "start", "plan", "initials"))):
            state, i, before = start, 0, []
            for letter in plan:
                if letter == KEEP:
                    state = KEPT[state, initials[i]]
                elif letter != DELETE:
                    state = MADE[state]
                if letter == INSERT:
                    (before if i < len(initials) else out[-1][4]).append(ROLES[state])
                else:
                    out.append((first + i, letter, ROLES[state] if letter == REROLE else None, before, []))
                    i, before = i + 1, []
        kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], ["pos", "edit", "made", "before", "behind"])


def spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def ordered(turns: DataFrame) -> DataFrame:
    """``conv``, ``pos``, ``turn``, ``role``, ``text``: all rows by conversation and turn, numbered in that order.

    Rows of one turn go by role and text. They are dealt out by ranges of all
    these and, for equal rows, of where they were read.
    """
    rows = turns.select(
        spaced(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), spaced(F.col("role")).alias("role"),
        spaced(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("_tie"),
    )
    keys = ["conv", "turn", "role", "text", "_tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return staged(rows.withColumn("pos", F.monotonically_increasing_id()), "turns")


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv``, ``pos``, ``initial`` and ``fault``, the first fault of each row; texts stay where they are."""
    said = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select(
        "conv", "pos", "role", F.substring("role", 1, 1).alias("initial"), F.md5("text").alias("digest"),
        F.when(said == "", BLANK).when(said.isin(".", "!", "?"), FINE).otherwise(CUT).alias("fault"),
    )
    # Stored, so that the join deals out both its sides itself and can split what is said very often.
    same = narrow.where(F.col("fault") != BLANK).groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    firsts = staged(same.where("n > 1").select("conv", "role", "digest", "first"), "firsts")
    again = (F.col("fault") != BLANK) & (F.col("pos") > F.col("first"))
    both = narrow.join(firsts, ["conv", "role", "digest"], "left")
    return both.select("conv", "pos", "initial", F.when(F.coalesce(again, F.lit(False)), DUPLICATE).otherwise(F.col("fault")).alias("fault"))


def planned(marks: DataFrame) -> DataFrame:
    """``pos``, ``edit``, ``made``, ``before`` and ``behind`` of every row."""
    legal = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    rows = marks.select("conv", "pos", F.shiftright("pos", SEGMENT_BITS).alias("segment"), F.struct("pos", legal.alias("i"), F.col("fault").alias("f")).alias("row"))
    segments = rows.groupBy("conv", "segment").agg(F.sort_array(F.collect_list("row")).alias("rows"), F.min("pos").alias("first")).select(
        "conv", "segment", "first", F.array_join(F.col("rows.i"), "").alias("initials"), F.array_join(F.col("rows.f"), "").alias("faults")
    )
    segments = staged(segments, "segments")
    several = staged(segments.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv", F.lit(True).alias("several")), "several")
    flagged = segments.join(several, "conv", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    kind = "conv string, segment long, several boolean, first long, plans array<string>, costs array<int>, ranks array<int>"
    plans = staged(flagged.mapInArrow(searched, kind), "plans")
    chains = plans.where("several").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("segment", "costs", "ranks"))).alias("chain"))
    picks = staged(chains.mapInArrow(chained, "conv string, segment long, start int, pick int"), "picks")
    chosen = plans.join(segments.select("conv", "segment", "initials"), ["conv", "segment"]).join(picks, ["conv", "segment"], "left")
    chosen = chosen.select(
        "first", F.coalesce("start", F.lit(BEGIN)).alias("start"), F.col("plans")[F.coalesce("pick", F.lit(ANY_END))].alias("plan"), "initials"
    )
    return chosen.mapInArrow(edited, "pos long, edit string, made string, before array<string>, behind array<string>")


def repaired(turns: DataFrame) -> DataFrame:
    """Each row of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``) with its repair.

    ``conv``, ``pos`` (order of the rows), ``turn``, ``role``, ``text``,
    ``initial``, ``fault`` (b blank, d duplicate, t truncated, . none), ``edit``
    (Keep, Rerole, Delete), and ``made``, the repaired turns it stands for as
    structs of role and text: inserted ones (empty text) and itself.

    A null is read as one space wherever it stands: such texts are blank, such
    roles no role, and all rows without a conversation are one. Rows without a
    turn number come first; rows of one turn number go by role and text, so
    repeated rows follow each other and all but the first are duplicates. Texts
    and conversations may be of any length. Other columns are ignored, an empty
    table has no rows.
    """
    small_batches(turns.sparkSession)
    rows = ordered(turns)
    marks = staged(with_faults(rows), "marks")
    plan = staged(planned(marks).withColumnRenamed("made", "role_made"), "edits")
    inserted = lambda names: F.transform(names, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.array(F.struct(F.coalesce("role_made", "role").alias("role"), F.col("text").alias("text")))
    none = F.filter(own, lambda _: F.lit(False))
    both = rows.join(marks.drop("conv"), "pos").join(plan, "pos")
    made = F.concat(inserted("before"), F.when(F.col("edit") == DELETE, none).otherwise(own), inserted("behind"))
    letters = F.concat(F.repeat(F.lit(INSERT), F.size("before")), F.col("edit"), F.repeat(F.lit(INSERT), F.size("behind")))
    return both.select("conv", "pos", "turn", "role", "text", "initial", "fault", "edit", letters.alias("letters"), made.alias("made"))


def reported(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of rows sorted by conversation and place, read as a stream."""
    names = ("conv", "turn", "initial", "fault", "letters", "said")
    state: dict | None = None

    def closed() -> dict:
        turns = state["turns"]
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        out = {k: state[k] for k in ("conv", *counted, "cost")}
        return out | {"gaps": gaps, "audit": "".join(state["letters"]), "repaired_sha256": state["digest"].hexdigest()}

    counted = ("blank", "duplicate", "truncated", "illegal")
    kinds = {BLANK: "blank", DUPLICATE: "duplicate", CUT: "truncated"}
    columns = ["conv", *counted, "cost", "gaps", "audit", "repaired_sha256"]
    for batch in batches:
        done = []
        rows = zip(*(batch.column(c).to_pylist() for c in names))
        for conv, some in groupby(rows, key=lambda r: r[0]):
            if state is None or state["conv"] != conv:
                if state is not None:
                    done.append(closed())
                state = {"conv": conv, "cost": 0, "turns": None, "letters": [], "digest": hashlib.sha256(), "said": False, "initial": None}
                state |= dict.fromkeys(counted, 0)
            for _, turn, initial, fault, letters, said in some:
                if turn is not None:
                    low, high, n = state["turns"] or (turn, None, 0)
                    state["turns"] = (low, turn, n + (turn != high))
                if fault in kinds:
                    state[kinds[fault]] += 1
                if state["initial"] is not None and state["initial"] + initial not in LEGAL_PAIRS:
                    state["illegal"] += 1
                state["initial"] = initial
                state["letters"].append(letters)
                state["cost"] += DELETE_COST * letters.count(DELETE) + INSERT_COST * letters.count(INSERT) + REROLE_COST * letters.count(REROLE)
                state["cost"] += CUT_COST * (fault == CUT and DELETE not in letters)
                if said is not None:
                    state["digest"].update(("\n" + said if state["said"] else said).encode())
                    state["said"] = True
        if done:
            yield pa.RecordBatch.from_pylist([{c: d[c] for c in columns} for d in done])
    if state is not None:
        yield pa.RecordBatch.from_pylist([{c: v for c, v in closed().items() if c in columns}]).select(columns)


def reports(repairs: DataFrame) -> DataFrame:
    """``conv`` with its faults, cost, plan (``audit``) and the digest of its repaired turns.

    A digest is made of the whole conversation in order, so its rows are read in
    one task, one after the other; nothing of them is kept but counts and letters.
    """
    lines = F.transform("made", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    said = F.when(F.size("made") > 0, F.array_join(lines, "\n"))
    rows = repairs.select("conv", "pos", "turn", "initial", "fault", "letters", said.alias("said"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "pos")
    kind = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, gaps long, audit string, repaired_sha256 string"
    return rows.mapInArrow(reported, kind)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults of all kinds, by the checksum of conversation and turn; nulls become one space."""
    fate = F.crc32(F.concat(spaced(F.col("conv_id")), F.lit(":"), spaced(F.col("turn"))).cast("binary")) % 20
    role, text = spaced(F.col("role")), spaced(F.col("text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("_fate")).where("_fate <> 0")
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select("conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies))
    return rows.select("conv_id", "turn", "role", "text")


def repair_reports(conversations: DataFrame) -> DataFrame:
    """The reports of damaged conversations, with a row for each conversation there was.

    A conversation that lost all its rows has zeros, an empty plan and the digest of nothing.
    """
    every = conversations.select("conv_id", spaced(F.col("conv_id")).alias("conv")).distinct()
    got = every.join(reports(repaired(damaged(conversations))), "conv", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return got.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


# The same by SQL: instead of a search, the best plan to each state row by row.
REPAIR_SQL = r"""
WITH RECURSIVE crc_bytes AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
named AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
fated AS (
  SELECT conv, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1]))) % 20 AS fate FROM named, crc_bytes),
damaged AS (
  SELECT conv, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, unnest(CASE fate WHEN 3 THEN [1, 2] ELSE [1] END) WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
said AS (SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ends FROM placed),
marked AS (
  SELECT conv, i, turn, role, text, left(role, 1) AS initial, CASE WHEN ends = '' THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd' WHEN ends IN ('.', '!', '?') THEN '.' ELSE 't' END AS fault FROM said),
lengths AS (SELECT conv, max(i) AS n FROM marked GROUP BY conv),
made AS (SELECT * FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) m(q, to_q)),
keeps AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) k(q, c, to_q)),
leads AS (
  SELECT q, q AS at, '' AS letters, 0 AS cost FROM made UNION ALL SELECT q, to_q, 'I', 2 FROM made
  UNION ALL SELECT a.q, b.to_q, 'II', 4 FROM made a JOIN made b ON b.q = a.to_q),
plans AS (
  SELECT conv, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit FROM lengths
  UNION ALL
  SELECT conv, i, q, best.c AS cost, best.a AS audit FROM (
    SELECT p.conv, m.i, e.q, min({'c': p.cost + l.cost + e.cost, 'a': p.audit || l.letters || e.letter}) AS best
    FROM plans p JOIN leads l ON l.q = p.q JOIN marked m ON m.conv = p.conv AND m.i = p.i + 1 JOIN LATERAL (
      SELECT l.at AS q, 3 AS cost, 'D' AS letter
      UNION ALL SELECT k.to_q, CASE m.fault WHEN 't' THEN 1 ELSE 0 END, 'K' FROM keeps k WHERE k.q = l.at AND k.c = m.initial AND m.fault NOT IN ('b', 'd')
      UNION ALL SELECT x.to_q, CASE m.fault WHEN 't' THEN 3 ELSE 2 END, 'R' FROM made x WHERE x.q = l.at AND m.fault NOT IN ('b', 'd')) e ON true
    GROUP BY p.conv, m.i, e.q)),
ends AS (
  SELECT conv, min({'c': cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'a': audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS best
  FROM plans JOIN lengths USING (conv) WHERE i = n GROUP BY conv),
letters AS (SELECT conv, best.a AS audit, unnest(range(1, length(best.a) + 1)) AS j FROM ends),
walked AS (
  SELECT conv, j, audit[j] AS letter, count(*) FILTER (audit[j] <> 'I') OVER w AS i, count(*) FILTER (audit[j] <> 'D') OVER w AS p,
    count(*) FILTER (audit[j] <> 'D') OVER (PARTITION BY conv) AS n FROM letters WINDOW w AS (PARTITION BY conv ORDER BY j)),
lines AS (
  SELECT w.conv, j, CASE letter WHEN 'K' THEN role ELSE CASE WHEN (n - p) % 2 = 0 THEN 'assistant' ELSE 'user' END END
    || ':' || CASE letter WHEN 'I' THEN '' ELSE text END AS line
  FROM walked w LEFT JOIN marked m ON m.conv = w.conv AND m.i = w.i WHERE letter <> 'D'),
texts AS (SELECT conv, sha256(string_agg(line, chr(10) ORDER BY j)) AS digest FROM lines GROUP BY conv),
pairs AS (SELECT conv, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM marked),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated FROM marked GROUP BY conv),
wrong AS (SELECT conv, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM named) LEFT JOIN counts USING (conv) LEFT JOIN wrong USING (conv) LEFT JOIN ends USING (conv) LEFT JOIN texts USING (conv)
"""
