"""Preference formatting of paired conversations.

A pair is a chosen and a rejected conversation. The longest run of turns both
begin with is rendered once, as the prompt; what follows in each is rendered as
its completion, with a mask over its characters that is 1 in turns of the
assistant (content and end mark) and 0 elsewhere.

Turns are compared where they meet: both sides are joined on pair and turn
number, the first place that differs is the smallest number of a turn without
an equal partner, and each turn then knows its part. A turn travels once per
pair; texts meet in one row only when the row itself is put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged

# Template of a turn: fixed values of the format.
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNT_ROLE = "assistant"


def paired(conversations: DataFrame) -> DataFrame:
    """``pair``, ``side`` and ordered turns out of ``conv_id``, ``turn``, ``role``, ``text``.

    Conversations 2k and 2k+1 are a pair, the even one chosen. Turns count by
    their place: repeated rows of a turn number are one turn (the smallest
    text), and rows without a conversation or a turn number are none.
    """
    conv = F.col("conv_id").cast("long")
    turns = conversations.select(
        F.shiftright(conv, 1).alias("pair"), F.pmod(conv, F.lit(2)).cast("int").alias("side"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.where(F.col("pair").isNotNull() & F.col("turn").isNotNull())
    return turns.groupBy("pair", "side", "turn").agg(F.min(F.struct("role", "text")).alias("said")).select("pair", "side", "turn", "said.*")


def answered(conversations: DataFrame) -> DataFrame:
    """``pair``, ``side`` and ordered turns: each conversation up to its last answer, chosen, and the same turns with
    the last answer of a neighbour in its place, rejected.

    The pair is numbered like the conversation; conversations 2k and 2k+1 are
    neighbours. One whose neighbour is missing or gives no answer is paired with
    its own turns without the answer, and is in no pair if there are none; one
    that gives no answer itself, or has no number, is in no pair either. Rows
    count as in :func:`paired`.
    """
    turns = paired(conversations).select(
        (2 * F.col("pair") + F.col("side")).alias("conv"), "turn", "role", "text"
    )
    last = F.max(F.struct("turn", "text"))
    answers = turns.where(F.col("role") == LEARNT_ROLE).groupBy("conv").agg(last.alias("answer")).select("conv", "answer.*")
    # Stored, so that the join of the turns deals out both its sides itself and can split a long conversation.
    answers = staged(answers, "answers")
    others = answers.select(F.col("conv").bitwiseXOR(F.lit(1)).alias("conv"), F.col("text").alias("other"), F.lit(True).alias("_other"))
    met = staged(answers.withColumnRenamed("turn", "at").drop("text").join(others, "conv", "left"), "answers")
    both = turns.join(met, "conv").where("turn <= at")
    chosen = F.struct(F.lit(0).alias("side"), F.col("role"), F.col("text"))
    rejected = F.when(F.col("turn") < F.col("at"), F.struct(F.lit(1).alias("side"), F.col("role"), F.col("text"))).when(
        F.col("_other"), F.struct(F.lit(1).alias("side"), F.col("role"), F.col("other").alias("text"))
    )
    said = both.select(F.col("conv").alias("pair"), "turn", F.explode(F.array_compact(F.array(chosen, rejected))).alias("said"))
    return said.select("pair", "said.side", "turn", "said.role", "said.text")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(BETWEEN), text, F.lit(CLOSE))


def turn_mask(role: Column, text: Column) -> Column:
    """A character per character of the rendered turn."""
    head = F.length(F.concat(F.lit(OPEN), role, F.lit(BETWEEN)))
    body = F.length(F.concat(text, F.lit(CLOSE)))
    flag = F.when(role == LEARNT_ROLE, "1").otherwise("0")
    return F.concat(F.call_function("repeat", F.lit("0"), head), F.call_function("repeat", flag, body))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair with both sides: prompt, completions, masks and turn counts.

    ``turns`` has ``pair``, ``side`` (0 chosen, 1 rejected), ``turn``, ``role``
    and ``text``. Pairs with only one side give no row, an empty table none. A side that ends where
    the other goes on has an empty completion; equal conversations have two.
    Turn numbers need not be gapless, but equal turns have equal numbers.
    """
    chosen = turns.where("side = 0").select("pair", "turn", F.struct("role", "text").alias("chosen"))
    rejected = turns.where("side = 1").select("pair", "turn", F.struct("role", "text").alias("rejected"))
    both = chosen.join(rejected, ["pair", "turn"], "full")
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    places = both.groupBy("pair").agg(
        F.min(F.when(differs, F.col("turn"))).alias("fork"),
        F.count("chosen").alias("n_chosen"), F.count("rejected").alias("n_rejected"),
        F.sort_array(F.collect_list(F.struct("turn", "chosen", "rejected"))).alias("turns"),
    ).where("n_chosen > 0 AND n_rejected > 0")

    def part(side: str, after: bool, mask: bool = False) -> Column:
        said = F.filter(
            "turns",
            lambda t: t[side].isNotNull()
            & (F.coalesce(t["turn"] >= F.col("fork"), F.lit(False)) if after else F.coalesce(t["turn"] < F.col("fork"), F.lit(True))),
        )
        made = turn_mask if mask else rendered
        return F.array_join(F.transform(said, lambda t: made(t[side]["role"], t[side]["text"])), "")

    shared = F.size(F.filter("turns", lambda t: F.coalesce(t["turn"] < F.col("fork"), F.lit(True))))
    return places.select(
        "pair", shared.alias("n_shared"), (F.col("n_chosen") - shared).alias("n_chosen"), (F.col("n_rejected") - shared).alias("n_rejected"),
        part("chosen", False).alias("prompt"),
        part("chosen", True).alias("chosen"), part("chosen", True, True).alias("chosen_mask"),
        part("rejected", True).alias("rejected"), part("rejected", True, True).alias("rejected_mask"),
    )


# The same by SQL.
PAIRS_SQL = r"""
WITH said AS (
  SELECT conv_id AS conv, turn, min({'r': coalesce(role, ''), 't': coalesce(text, '')}) AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
answers AS (SELECT conv, max({'turn': turn, 'text': said.t}) AS answer FROM said WHERE said.r = 'assistant' GROUP BY conv),
turns AS (
  SELECT conv AS pair, 0 AS side, turn, said FROM said JOIN answers USING (conv) WHERE turn <= answer.turn
  UNION ALL SELECT conv, 1, turn, said FROM said JOIN answers USING (conv) WHERE turn < answer.turn
  UNION ALL SELECT a.conv, 1, a.answer.turn, {'r': 'assistant', 't': b.answer.text} FROM answers a JOIN answers b ON b.conv = xor(a.conv, 1)),
met AS (
  SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.turn, b.turn) AS turn, a.said AS c, b.said AS r
  FROM (SELECT * FROM turns WHERE side = 0) a FULL JOIN (SELECT * FROM turns WHERE side = 1) b ON a.pair = b.pair AND a.turn = b.turn),
forks AS (
  SELECT pair, min(turn) FILTER (c IS DISTINCT FROM r) AS fork FROM met GROUP BY pair HAVING count(c) > 0 AND count(r) > 0),
parts AS (
  SELECT pair, turn, coalesce(turn < fork, true) AS common, c, r,
    '<|' || c.r || '|>' || chr(10) || c.t || '<|end|>' || chr(10) AS ct, '<|' || r.r || '|>' || chr(10) || r.t || '<|end|>' || chr(10) AS rt,
    repeat('0', length(c.r) + 5) || repeat(CASE WHEN c.r = 'assistant' THEN '1' ELSE '0' END, length(c.t) + 8) AS cm,
    repeat('0', length(r.r) + 5) || repeat(CASE WHEN r.r = 'assistant' THEN '1' ELSE '0' END, length(r.t) + 8) AS rm
  FROM met JOIN forks USING (pair))
SELECT pair, CAST(count(*) FILTER (common) AS INT) AS n_shared,
  count(c) FILTER (NOT common) AS n_chosen, count(r) FILTER (NOT common) AS n_rejected,
  coalesce(string_agg(ct, '' ORDER BY turn) FILTER (common), '') AS prompt,
  coalesce(string_agg(ct, '' ORDER BY turn) FILTER (NOT common), '') AS chosen,
  coalesce(string_agg(cm, '' ORDER BY turn) FILTER (NOT common), '') AS chosen_mask,
  coalesce(string_agg(rt, '' ORDER BY turn) FILTER (NOT common), '') AS rejected,
  coalesce(string_agg(rm, '' ORDER BY turn) FILTER (NOT common), '') AS rejected_mask
FROM parts GROUP BY pair
"""
