"""Declarative data-quality rules, compiled to as few scans as they need."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ..functions.lists import subset_of
from .keys import lookup_join, order_value
from .shaping import conform, fill_missing

# Rule kinds as suite documents name them.
COLUMNS_MATCH = "expect_table_columns_to_match_ordered_list"
TYPE_IN_LIST = "expect_column_values_to_be_in_type_list"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE_PROPORTION = "expect_column_proportion_of_unique_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
IS_LIST = "expect_type_list"
LIST_IN_SET = "expect_column_list_to_be_in_set"
NON_EMPTY_UNIQUE = "expect_non_empty_unique"

SAMPLES = 20

_RESULT_TYPE = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("element_count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("unexpected_percent", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)
# What an aggregate rule has seen goes along with its result until samples are added.
OBSERVED = "_observed"
_OBSERVED_TYPE = T.StructType([*_RESULT_TYPE, T.StructField(OBSERVED, T.StringType())])


@dataclass(frozen=True)
class Rule:
    """One rule: kind, column and arguments; ``mostly`` is the share that must pass."""

    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)
    mostly: float = 1.0
    row_condition: str | None = None

    def __post_init__(self):
        if isinstance(self.mostly, bool) or not isinstance(self.mostly, (int, float)):
            raise ValueError("mostly must be a number")
        if not 0 <= self.mostly <= 1:
            raise ValueError("mostly must be between 0 and 1")
        if self.column is None and self.kind != COLUMNS_MATCH:
            raise ValueError(f"{self.kind} needs a column")


@dataclass(frozen=True)
class _RowRule:
    bad: Callable[[Column, dict, DataFrame, str], Column]
    counts_null: bool  # nulls are elements of the rule, not missing values


def _not_list(c: Column, params: dict, df: DataFrame, name: str) -> Column:
    return c.isNull() if isinstance(df.schema[name].dataType, T.ArrayType) else F.lit(True)


_ROW_RULES: dict[str, _RowRule] = {
    NOT_NULL: _RowRule(lambda c, p, df, n: c.isNull(), True),
    IS_LIST: _RowRule(_not_list, True),
    IN_SET: _RowRule(lambda c, p, df, n: ~c.isin(list(p["value_set"])), False),
    LIST_IN_SET: _RowRule(lambda c, p, df, n: ~subset_of(c, list(p["value_set"])), False),
}


@dataclass(frozen=True)
class _AggregateRule:
    states: Callable[[Column, dict], dict[str, Column]]
    verdict: Callable[[dict[str, Column], dict], Column]


@dataclass(frozen=True)
class _KeyedRule:
    bad: Callable[[Column, Column, dict], Column]
    spares_first: bool  # of a bad value the first row is expected


def _repeated_text(value: Column, times: Column, params: dict) -> Column:
    return (times > 1) & (value.cast("string") != "")


_AGGREGATE_RULES: dict[str, _AggregateRule] = {}
_KEYED_RULES: dict[str, _KeyedRule] = {
    UNIQUE_PROPORTION: _KeyedRule(lambda value, times, params: times > 1, True),
    NON_EMPTY_UNIQUE: _KeyedRule(_repeated_text, True),
}
_PLAN_RULES = (COLUMNS_MATCH, TYPE_IN_LIST)
_SURE_RULES = (NOT_NULL, IS_LIST, IN_SET, LIST_IN_SET)


def register_rule(
    kind: str, bad: Callable[[Column, dict], Column], counts_null: bool = False
) -> None:
    """Add a rule kind: ``bad(column, params)`` is true for a row that breaks it.

    Use ``try_*`` functions in it: what fails while rows are read fails the run.
    """
    _ROW_RULES[kind] = _RowRule(lambda c, p, df, n: bad(c, p), counts_null)


def register_aggregate_rule(
    kind: str, states: Callable[[Column, dict], dict[str, Column]], verdict: Callable[[dict[str, Column], dict], Column]
) -> None:
    """Add a rule kind on a column as a whole.

    ``states(column, params)`` names aggregates of the column, which is null in
    rows outside the rule's condition; ``verdict(states, params)`` is true if the
    rule holds for them, and false if it is null. All rules of a suite share one
    aggregate, these too; their states are the sample of the result, as JSON.
    """
    _AGGREGATE_RULES[kind] = _AggregateRule(states, verdict)


def register_keyed_rule(kind: str, bad: Callable[[Column, Column, dict], Column], spares_first: bool = False) -> None:
    """Add a rule kind on how often values occur.

    ``bad(value, times, params)`` is true for a value that breaks the rule with
    ``times`` rows; all its rows are unexpected, but for the first with
    ``spares_first``. Nulls are missing values. Keyed rules of one column share
    the count per value, also with the uniqueness rules.
    """
    _KEYED_RULES[kind] = _KeyedRule(bad, spares_first)


def suite_from_json(text: str) -> list[Rule]:
    """Rules of a suite document (``expectations`` with type and kwargs)."""
    rules = []
    for item in json.loads(text)["expectations"]:
        params = dict(item.get("kwargs", {}))
        rules.append(
            Rule(
                kind=item["expectation_type"],
                column=params.pop("column", None),
                mostly=params.pop("mostly", 1.0),
                row_condition=params.pop("row_condition", None),
                params=params,
            )
        )
    return rules


def _condition(rule: Rule) -> Column:
    if rule.row_condition is None:
        return F.lit(True)
    return F.coalesce(F.expr(rule.row_condition), F.lit(False))


def _bad(df: DataFrame, rule: Rule) -> Column:
    kind = _ROW_RULES[rule.kind]
    return F.coalesce(kind.bad(F.col(rule.column), rule.params, df, rule.column), F.lit(False))


def _plan_error(df: DataFrame, rule: Rule) -> str | None:
    """Why a rule cannot run on this frame, found without reading any row."""
    if not any(rule.kind in kinds for kinds in (_ROW_RULES, _AGGREGATE_RULES, _KEYED_RULES, _PLAN_RULES)):
        return f"unknown rule {rule.kind}"
    if rule.column is not None and rule.column not in df.columns:
        return f"unknown column {rule.column}"
    try:
        if rule.kind in _ROW_RULES:
            df.select(_bad(df, rule) & _condition(rule)).schema
        elif rule.kind in _AGGREGATE_RULES:
            states = _states(rule, "s")
            verdict = _AGGREGATE_RULES[rule.kind].verdict({n: F.col(c) for n, (c, _) in states.items()}, rule.params)
            df.agg(*[state.alias(c) for c, state in states.values()]).select(verdict & F.lit(True)).schema
        elif rule.kind in _KEYED_RULES:
            df.filter(_condition(rule)).groupBy(rule.column).count().select(_is_bad_value(rule, F.col("count"))).schema
    except PySparkException as error:
        return str(error).splitlines()[0]
    except (KeyError, TypeError, ValueError) as error:
        return f"{type(error).__name__}: {error}"
    return None


def _plan_success(df: DataFrame, rule: Rule) -> bool:
    if rule.kind == COLUMNS_MATCH:
        return df.columns == list(rule.params["column_list"])
    kind = df.schema[rule.column].dataType
    names = {type(kind).__name__, kind.simpleString(), kind.simpleString().upper(), kind.typeName()}
    return bool(names & set(rule.params["type_list"]))


def _states(rule: Rule, prefix: str) -> dict[str, tuple[str, Column]]:
    """The aggregates of an aggregate rule by name, each with a column to hold it."""
    value = F.when(_condition(rule), F.col(rule.column))
    found = _AGGREGATE_RULES[rule.kind].states(value, rule.params)
    return {name: (f"{prefix}_{i}", state) for i, (name, state) in enumerate(found.items())}


def _result(
    position: int, rule: Rule, element=None, missing=None, bad=None, of=None, success=None, error=None, observed=None
) -> Column:
    """One result row; ``of`` is the number of values the bad ones are a share of."""
    null = F.lit(None)
    share = null if bad is None else F.coalesce(F.try_divide(F.lit(100.0) * bad, of), F.lit(0.0))
    values = {
        "position": F.lit(position),
        "rule": F.lit(rule.kind),
        "column": F.lit(rule.column),
        "element_count": null if element is None else element,
        "missing_count": null if missing is None else missing,
        "unexpected_count": null if bad is None else bad,
        "unexpected_percent": share,
        "success": success if isinstance(success, Column) else F.lit(success),
        "error": F.lit(error),
        OBSERVED: null if observed is None else observed,
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in _OBSERVED_TYPE])


def _within(rule: Rule, bad: Column, of: Column) -> Column:
    """At least ``mostly`` of the values pass; true for none at all."""
    return (of == 0) | (F.try_divide(of - bad, of) >= F.lit(float(rule.mostly)))


def _row_counts(df: DataFrame, rules: list[tuple[int, Rule]]) -> tuple[list[Column], list[Column]]:
    """The aggregates of row rules and aggregate rules, and the result rows they make."""
    counts, rows = [], []
    for position, rule in rules:
        inside, value = _condition(rule), F.col(rule.column)
        counts += [
            F.count_if(inside).alias(f"n{position}"),
            F.count_if(inside & value.isNull()).alias(f"m{position}"),
        ]
        element, missing, bad = (F.col(f"{p}{position}") for p in "nmb")
        if rule.kind in _AGGREGATE_RULES:
            states = _states(rule, f"s{position}")
            counts += [state.alias(name) for name, state in states.values()]
            held = {name: F.col(column) for name, (column, _) in states.items()}
            verdict = F.coalesce(_AGGREGATE_RULES[rule.kind].verdict(held, rule.params), F.lit(False))
            seen = F.to_json(F.struct(*[c.alias(n) for n, c in held.items()])) if held else F.lit("{}")
            rows.append(_result(position, rule, element, missing, success=verdict, observed=seen))
            continue
        counts.append(F.count_if(inside & _bad(df, rule) & _is_element(rule)).alias(f"b{position}"))
        of = element if _ROW_RULES[rule.kind].counts_null else element - missing
        rows.append(_result(position, rule, element, missing, bad, of, _within(rule, bad, of)))
    return counts, rows


def _row_results(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """All row rules and aggregate rules in one aggregate over one scan."""
    counts, rows = _row_counts(df, rules)
    return df.agg(*counts).select(F.inline(F.array(*rows)))


ROWS = "_rows"


class WatchedRules:
    """Row rules of a suite, counted while a table is written.

    Only kinds that cannot fail in a row, without a condition of their own, are
    counted on the way; :meth:`results` has them once the rows are written, and
    :attr:`rest` the positions and rules that need the table.
    """

    def __init__(self, df: DataFrame, suite: list[Rule]):
        numbered = list(enumerate(suite))
        self._rules = [
            (p, rule) for p, rule in numbered if rule.kind in _SURE_RULES and rule.row_condition is None and _plan_error(df, rule) is None
        ]
        self.rest = [(p, rule) for p, rule in numbered if (p, rule) not in self._rules]
        self._seen = Observation()
        counts, self._rows = _row_counts(df, self._rules)
        self.frame = df.observe(self._seen, F.count("*").alias(ROWS), *counts) if self._rules else df

    def results(self, written: DataFrame) -> DataFrame | None:
        """The results, without samples; None if the rows that were counted are not those of the table."""
        if not self._rules:
            return None
        seen = self._seen.get
        # The number of rows comes from the footers of the files.
        if seen[ROWS] != written.count():
            return None
        values = [F.lit(v).cast("bigint").alias(name) for name, v in seen.items()]
        return written.sparkSession.range(1).select(*values).select(F.inline(F.array(*self._rows))).drop(OBSERVED)


def _is_element(rule: Rule) -> Column:
    return F.lit(True) if _ROW_RULES[rule.kind].counts_null else F.col(rule.column).isNotNull()


def _per_value(df: DataFrame, column: str, rules: list[tuple[int, Rule]]) -> DataFrame:
    """How often each value of a column occurs, within each rule's condition."""
    return df.groupBy(column).agg(
        *[F.count_if(_condition(rule)).alias(f"c{position}") for position, rule in rules]
    )


def _is_bad_value(rule: Rule, times: Column) -> Column:
    """True for a value that breaks a keyed rule with so many rows."""
    value = F.col(rule.column)
    broken = _KEYED_RULES[rule.kind].bad(value, times, rule.params)
    return value.isNotNull() & (times > 0) & F.coalesce(broken, F.lit(False))


def _bad_rows(rule: Rule, times: Column) -> Column:
    """How many of its rows a bad value has too many."""
    return times - 1 if _KEYED_RULES[rule.kind].spares_first else times


def _keyed_results(df: DataFrame, column: str, rules: list[tuple[int, Rule]]) -> DataFrame:
    """All keyed rules of one column from one count per value."""
    totals, rows = [], []
    for position, rule in rules:
        here = F.col(f"c{position}")
        repeats = F.when(_is_bad_value(rule, here), _bad_rows(rule, here))
        totals += [
            F.coalesce(F.sum(here), F.lit(0)).alias(f"n{position}"),
            F.coalesce(F.sum(F.when(F.col(column).isNull(), here)), F.lit(0)).alias(f"m{position}"),
            F.coalesce(F.sum(repeats), F.lit(0)).alias(f"b{position}"),
        ]
        element, missing, bad = (F.col(f"{p}{position}") for p in "nmb")
        of = element - missing
        if rule.kind != UNIQUE_PROPORTION:
            success = _within(rule, bad, of)
        else:
            unique = F.try_divide(of - bad, of)
            low, high = rule.params.get("min_value"), rule.params.get("max_value")
            success = (of == 0) | (
                (F.lit(True) if low is None else unique >= F.lit(float(low)))
                & (F.lit(True) if high is None else unique <= F.lit(float(high)))
            )
        rows.append(_result(position, rule, element, missing, bad, of, success))
    return _per_value(df, column, rules).agg(*totals).select(F.inline(F.array(*rows)))


def _as_text(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(name) if nested else F.col(name).cast("string")


def _first_samples(values: DataFrame, limit: int | None) -> DataFrame:
    """The smallest values per rule; cut to the sample size before the shuffle."""
    if limit is None:
        return values.groupBy("position").agg(F.sort_array(F.collect_list("value")).alias("sample"))
    by = Window.partitionBy("position").orderBy("value")
    return (
        values.withColumn("_rank", F.row_number().over(by))
        .filter(F.col("_rank") <= limit)
        .groupBy("position")
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )


def _listed(found: list[tuple[int, Column, Column]]) -> Column:
    """Rows ``(position, value)`` of the rules that a row breaks."""
    entries = [
        F.when(bad, F.struct(F.lit(position).alias("position"), text.alias("value")))
        for position, bad, text in found
    ]
    return F.inline(F.array_compact(F.array(*entries)))


def _found(df: DataFrame, row_rules: list, keyed_rules: dict[str, list]) -> DataFrame | None:
    """``position`` and ``value`` of all bad values of rules on rows and keys.

    Row rules take one scan; keyed rules reuse the exchange of their counts.
    """
    parts = []
    row_rules = [(p, rule) for p, rule in row_rules if rule.kind in _ROW_RULES]
    if row_rules:
        found = [
            (p, _condition(rule) & _bad(df, rule) & F.col(rule.column).isNotNull(), _as_text(df, rule.column))
            for p, rule in row_rules
        ]
        any_bad = reduce(lambda a, b: a | b, [bad for _, bad, _ in found])
        parts.append(df.filter(any_bad).select(_listed(found)))
    for column, rules in keyed_rules.items():
        text = _as_text(df, column)
        found = [(p, _is_bad_value(rule, F.col(f"c{p}")), text) for p, rule in rules]
        parts.append(_per_value(df, column, rules).select(_listed(found)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _samples(df: DataFrame, row_rules: list, keyed_rules: dict[str, list], limit: int | None) -> DataFrame:
    """Up to ``limit`` bad values per rule, the smallest ones, or all."""
    found = _found(df, row_rules, keyed_rules)
    if found is None:
        return df.sparkSession.createDataFrame([], "position int, sample array<string>")
    return _first_samples(found, limit)


def _sorted_out(df: DataFrame, numbered: list[tuple[int, Rule]]) -> tuple[list, dict[str, list]]:
    """The rules on rows, and those on keys by column, that can run on a frame."""
    row_rules, keyed_rules = [], {}
    for p, rule in numbered:
        if rule.kind in _ROW_RULES and _plan_error(df, rule) is None:
            row_rules.append((p, rule))
        elif rule.kind in _KEYED_RULES and _plan_error(df, rule) is None:
            keyed_rules.setdefault(rule.column, []).append((p, rule))
    return row_rules, keyed_rules


def bad_values(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """All bad values of all rules on rows and keys as a table: ``position``, ``rule``, ``column``, ``value``.

    A value of a keyed rule is listed once, one of a rule on rows as often as it
    occurs. Nulls have no value to list. Nothing is gathered by rule, so any
    number of values will do.
    """
    found = _found(df, *_sorted_out(df, list(enumerate(suite))))
    if found is None:
        found = df.sparkSession.createDataFrame([], "position int, value string")
    named = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column")) for r in suite]) if suite else F.array()
    rule = F.get(named, F.col("position"))
    return found.select("position", rule["rule"].alias("rule"), rule["column"].alias("column"), "value") if suite else found.select(
        "position", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("column"), "value"
    )


def run_suite(df: DataFrame, suite: list[Rule], detail: str = "basic", samples: int = SAMPLES) -> DataFrame:
    """One result row per rule.

    Rules on rows share one aggregate, rules on uniqueness one count per
    column; rules on names and types, and rules that cannot run, need no scan.
    ``detail='basic'`` adds up to ``samples`` bad values per rule, ``'complete'``
    all of them (for tables of few bad values: they end in one row; :func:`bad_values` has them as a table),
    ``'summary'`` none.
    """
    return _run(df, list(enumerate(suite)), detail, samples)


def _run(df: DataFrame, numbered: list[tuple[int, Rule]], detail: str, samples: int = SAMPLES) -> DataFrame:
    static, row_rules = [], []
    unique_rules: dict[str, list[tuple[int, Rule]]] = {}
    for position, rule in numbered:
        error = _plan_error(df, rule)
        if error is None and rule.kind in _PLAN_RULES:
            try:
                static.append(_result(position, rule, success=_plan_success(df, rule)))
                continue
            except KeyError as missing:
                error = f"missing argument {missing}"
        if error is not None:
            static.append(_result(position, rule, success=False, error=error))
        elif rule.kind in _KEYED_RULES:
            unique_rules.setdefault(rule.column, []).append((position, rule))
        else:
            row_rules.append((position, rule))

    parts = []
    if row_rules:
        parts.append(_row_results(df, row_rules))
    for column, rules in unique_rules.items():
        parts.append(_keyed_results(df, column, rules))
    if static:
        parts.append(_constant(df, static))
    if not parts:
        parts.append(conform(df.sparkSession.range(0).select(), _OBSERVED_TYPE))
    results = reduce(DataFrame.unionByName, parts)
    if detail == "summary":
        return results.drop(OBSERVED)
    none = F.array().cast("array<string>")
    if not (row_rules or unique_rules):
        return results.drop(OBSERVED).withColumn("sample", none)
    shown = _samples(df, row_rules, unique_rules, samples if detail == "basic" else None)
    shown = F.broadcast(shown) if detail == "basic" else shown  # ``samples`` values per rule
    seen = F.when(F.col(OBSERVED).isNotNull(), F.array(OBSERVED))
    return results.join(shown, "position", "left").withColumn("sample", F.coalesce("sample", seen, none)).drop(OBSERVED)


def _constant(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def check_suite(
    df: DataFrame, suite: list[Rule], detail: str = "basic", samples: int = SAMPLES, watched: WatchedRules | None = None
) -> DataFrame:
    """The results of :func:`run_suite`, evaluated: one row per rule.

    If a rule fails while rows are read, the suite is halved until the rule
    stands alone and gets a failed result with its error; the others are
    unharmed. With ``detail='complete'`` the samples are all bad values, put
    together by the executors when the result is used; nothing but the counts
    of a rule comes to the driver. Rules that ``watched`` has counted while the
    table was written are not counted again; of those that failed, samples are
    looked for.
    """
    if detail == "complete":
        results = check_suite(df, suite, "summary", watched=watched)
        failed = {r["position"] for r in results.filter("NOT success OR unexpected_count > 0").filter("error IS NULL").collect()}
        bad = _samples(df, *_sorted_out(df, [(p, rule) for p, rule in enumerate(suite) if p in failed]), None)
        return results.join(bad, "position", "left").withColumn("sample", F.coalesce("sample", F.array().cast("array<string>")))
    counted = None if watched is None else watched.results(df)
    with_samples = [T.StructField("sample", T.ArrayType(T.StringType()))] if detail != "summary" else []
    schema = T.StructType(_RESULT_TYPE.fields + with_samples)

    def evaluated(numbered: list[tuple[int, Rule]]) -> list:
        try:
            return _run(df, numbered, detail, samples).select(*schema.names).collect()
        except PySparkException as error:
            if len(numbered) > 1:
                half = len(numbered) // 2
                return evaluated(numbered[:half]) + evaluated(numbered[half:])
            position, rule = numbered[0]
            reason = str(error).splitlines()[0]
            failed = _constant(df, [_result(position, rule, success=False, error=reason)])
            return fill_missing(conform(failed, schema), [f.name for f in with_samples]).collect()

    numbered, known = list(enumerate(suite)), []
    if counted is not None:
        known = counted.collect()
        # What has passed has no bad values to show.
        passed = {r["position"] for r in known if detail == "summary" or r["unexpected_count"] == 0}
        known = [(*r, []) if with_samples else tuple(r) for r in known if r["position"] in passed]
        numbered = [(p, rule) for p, rule in numbered if p not in passed]
    return df.sparkSession.createDataFrame([*known, *(evaluated(numbered) if numbered else [])], schema)


def unexpected_values(df: DataFrame, rule: Rule) -> DataFrame:
    """``(value, unexpected_count)`` of a rule on rows or keys, largest groups included whole.

    Of a repeated value the first is expected, so it counts once less.
    """
    text = _as_text(df, rule.column)
    if rule.kind not in _KEYED_RULES:
        bad = unexpected_rows(df, rule).select(text.alias("value"))
        return bad.groupBy("value").agg(F.count("*").alias("unexpected_count"))
    repeated = _per_value(df, rule.column, [(0, rule)]).filter(_is_bad_value(rule, F.col("c0")))
    return repeated.select(text.alias("value"), _bad_rows(rule, F.col("c0")).alias("unexpected_count"))


def unexpected_rows(df: DataFrame, rule: Rule, order: list[str] | None = None) -> DataFrame:
    """The rows that break a rule on rows or keys.

    For a uniqueness rule these are the rows of a value after its first one by
    ``order`` (a total order).
    """
    if rule.kind in _AGGREGATE_RULES:
        raise ValueError(f"{rule.kind} holds or fails for the table, not for rows of it")
    if rule.kind not in _KEYED_RULES:
        return df.filter(_condition(rule) & _bad(df, rule) & _is_element(rule))
    spares = _KEYED_RULES[rule.kind].spares_first
    if not order and spares:
        raise ValueError("a uniqueness rule needs the order that tells which row is first")
    rows = df.filter(_condition(rule) & F.col(rule.column).isNotNull())
    first = (
        rows.groupBy(rule.column)
        .agg((F.min(order_value(order)) if spares else F.lit(None)).alias("_first"), F.count("*").alias("_n"))
        .filter(_is_bad_value(rule, F.col("_n")))
        .select(F.col(rule.column).alias("_value"), "_first")
    )
    repeated = lookup_join(rows, first, F.col(rule.column), F.col("_value"), "inner")
    return (repeated.filter(order_value(order) > F.col("_first")) if spares else repeated).select(*df.columns)


def suite_passed(results: DataFrame) -> DataFrame:
    """One row, ``passed``: every rule succeeded."""
    return results.agg(F.coalesce(F.bool_and("success"), F.lit(True)).alias("passed"))
