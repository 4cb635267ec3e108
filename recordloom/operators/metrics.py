"""Metric states of a suite: kept per batch, merged for the whole table.

A batch is read once. What is left of it is a row per rule: counts, and for
rules on uniqueness a sketch of the distinct values, a few kilobytes whatever
the size of the batch. The states of all batches give the results of the table
they make up, so that an appended batch is checked without reading the others.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .quality import (
    NON_EMPTY_UNIQUE,
    UNIQUE_PROPORTION,
    Rule,
    _bad,
    _condition,
    _is_element,
    _ROW_RULES,
)

# Sketches have 2 ** LG_K places.
LG_K = 12
# Estimates are off by more than this share in about one case of a thousand.
ERROR_BOUND = 3.3 * 1.04 / math.sqrt(2**LG_K)

_STATE = "position int, n bigint, m bigint, b bigint, distinct binary"


def _state(df: DataFrame, position: int, rule: Rule) -> tuple[list[Column], Column]:
    """The aggregates of a rule, and the row they make."""
    if rule.kind not in (*_ROW_RULES, UNIQUE_PROPORTION, NON_EMPTY_UNIQUE):
        raise ValueError(f"{rule.kind} has no states that can be merged")
    inside, value = _condition(rule), F.col(rule.column)
    n, m, b, d = (f"{p}{position}" for p in "nmbd")
    counts = [F.count_if(inside).alias(n), F.count_if(inside & value.isNull()).alias(m)]
    bad, distinct = F.lit(None), F.lit(None)
    if rule.kind in _ROW_RULES:
        counts.append(F.count_if(inside & _bad(df, rule) & _is_element(rule)).alias(b))
        bad = F.col(b)
    else:
        text = F.when(inside, value.cast("string"))
        if rule.kind == NON_EMPTY_UNIQUE:
            text = F.when(text != "", text)
        # Of these rules ``b`` counts the values that the sketch has seen.
        counts += [F.count(text).alias(b), F.hll_sketch_agg(text, F.lit(LG_K)).alias(d)]
        bad, distinct = F.col(b), F.col(d)
    values = {"position": F.lit(position), "n": F.col(n), "m": F.col(m), "b": bad, "distinct": distinct}
    kinds = dict(part.split() for part in _STATE.split(", "))
    return counts, F.struct(*[c.cast(kinds[name]).alias(name) for name, c in values.items()])


def metric_states(batch: DataFrame, suite: list[Rule]) -> DataFrame:
    """One row per rule: ``position``, ``n`` rows, ``m`` missing ones, ``b`` bad ones (rules on uniqueness: values) and ``distinct``.

    Row rules and rules on uniqueness only; all of them share one aggregate over
    one scan of the batch, without a count per value.
    """
    parts = [_state(batch, position, rule) for position, rule in enumerate(suite)]
    if not parts:
        return batch.sparkSession.createDataFrame([], _STATE)
    counts = reduce(lambda a, b: a + b, [c for c, _ in parts])
    return batch.agg(*counts).select(F.inline(F.array(*[row for _, row in parts])))


def merged_results(states: DataFrame, suite: list[Rule]) -> DataFrame:
    """The results of the whole table out of the states of its batches, one row per rule.

    Columns as :func:`run_suite` has them, without samples, and
    ``error_bound``: 0 for row rules, whose counts are exact. For rules on
    uniqueness the number of distinct values is an estimate that is off by up to
    this share. Their ``success`` is true or false where every number within the
    bound says so, else null: undecided, to be counted exactly.
    """
    sums = states.groupBy("position").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("b").alias("b"), F.hll_union_agg("distinct").alias("distinct")
    )
    sums = sums.withColumn("d", F.least(F.hll_sketch_estimate("distinct"), F.col("b")))
    if not suite:
        return sums.limit(0).select("position")
    n, m, b, d = (F.col(c) for c in ("n", "m", "b", "d"))
    of = n - m
    cases: dict[str, list[Column]] = {"bad": [], "of": [], "success": [], "rule": [], "column": [], "bound": []}
    for position, rule in enumerate(suite):
        here = F.col("position") == position

        def case(name: str, value: Column) -> None:
            cases[name].append(F.when(here, value))  # noqa: B023

        case("rule", F.lit(rule.kind))
        case("column", F.lit(rule.column))
        if rule.kind in _ROW_RULES:
            total = n if _ROW_RULES[rule.kind].counts_null else of
            case("bad", b)
            case("of", total)
            case("bound", F.lit(0.0))
            case("success", (total == 0) | (F.try_divide(total - b, total) >= F.lit(float(rule.mostly))))
        else:
            case("bad", b - d)
            case("of", of)
            case("bound", F.lit(ERROR_BOUND))
            case("success", F.when(of == 0, F.lit(True)).otherwise(_decided(rule, of, b, d)))
    pick = {name: F.coalesce(*columns) for name, columns in cases.items()}
    share = F.coalesce(F.try_divide(F.lit(100.0) * pick["bad"], pick["of"]), F.lit(0.0))
    return sums.select(
        "position", pick["rule"].alias("rule"), pick["column"].alias("column"), n.alias("element_count"), m.alias("missing_count"),
        pick["bad"].alias("unexpected_count"), share.alias("unexpected_percent"), pick["success"].alias("success"),
        pick["bound"].alias("error_bound"),
    )


def _decided(rule: Rule, of: Column, seen: Column, distinct: Column) -> Column:
    """Whether a rule on uniqueness holds for all numbers of distinct values within the bound, or for none."""
    # One value at least, if any was seen, and no more than were seen.
    least = F.greatest(F.ceil(distinct / F.lit(1 + ERROR_BOUND)), F.least(seen, F.lit(1)))
    most = F.least(F.ceil(distinct / F.lit(1 - ERROR_BOUND)), seen)
    low_share, high_share = (F.try_divide(of - (seen - x), of) for x in (least, most))
    if rule.kind == NON_EMPTY_UNIQUE:
        low, high = float(rule.mostly), None
    else:
        low, high = rule.params.get("min_value"), rule.params.get("max_value")
    holds = (F.lit(True) if low is None else low_share >= F.lit(float(low))) & (F.lit(True) if high is None else high_share <= F.lit(float(high)))
    fails = (F.lit(False) if low is None else high_share < F.lit(float(low))) | (F.lit(False) if high is None else low_share > F.lit(float(high)))
    return F.when(holds, True).when(fails, False)
