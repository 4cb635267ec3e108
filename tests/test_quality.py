import functools
import json

import pytest
from pyspark.sql import functions as F

import recordloom as rl
from conftest import values
from recordloom.operators import quality
from recordloom.operators.quality import (
    COLUMNS_MATCH, IN_SET, IS_LIST, LIST_IN_SET, NON_EMPTY_UNIQUE, NOT_NULL, TYPE_IN_LIST, UNIQUE_PROPORTION,
)

ROWS = [
    (1, "A", "u1", ["x"], 1.0),
    (2, "B", "u1", ["x", "q"], None),
    (3, None, "", [], 2.0),
    (4, "A", "", None, 3.0),
    (4, "Z", None, ["y", None], 4.0),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, flag string, url string, tags array<string>, v double")


def result(df, rule, detail="basic"):
    return rl.run_suite(df, [rule], detail).first().asDict()


@pytest.mark.parametrize(
    "rule, element, missing, bad, success, sample",
    [
        (rl.Rule(NOT_NULL, "flag"), 5, 1, 1, False, []),
        (rl.Rule(NOT_NULL, "id"), 5, 0, 0, True, []),
        (rl.Rule(NOT_NULL, "flag", mostly=0.8), 5, 1, 1, True, []),
        (rl.Rule(IN_SET, "flag", {"value_set": ["A", "B"]}), 5, 1, 1, False, ["Z"]),
        (rl.Rule(IN_SET, "flag", {"value_set": ["A", "B"]}, mostly=0.75), 5, 1, 1, True, ["Z"]),
        (rl.Rule(IN_SET, "flag", {"value_set": ["A", "B"]}, mostly=0.76), 5, 1, 1, False, ["Z"]),
        (rl.Rule(IN_SET, "flag", {"value_set": ["A"]}, row_condition="id < 3"), 2, 0, 1, False, ["B"]),
        (rl.Rule(IN_SET, "flag", {"value_set": ["A"]}, row_condition="id > 99"), 0, 0, 0, True, []),
        (rl.Rule(IS_LIST, "tags"), 5, 1, 1, False, []),
        (rl.Rule(IS_LIST, "id"), 5, 0, 5, False, ["1", "2", "3", "4", "4"]),
        (rl.Rule(LIST_IN_SET, "tags", {"value_set": ["x", "y"]}), 5, 1, 2, False, ['["x","q"]', '["y",null]']),
        (rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 1, "max_value": 1}), 5, 0, 1, False, ["4"]),
        (rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 0.8}), 5, 0, 1, True, ["4"]),
        (rl.Rule(UNIQUE_PROPORTION, "id", {"max_value": 0.5}), 5, 0, 1, False, ["4"]),
        (rl.Rule(NON_EMPTY_UNIQUE, "url"), 5, 1, 1, False, ["u1"]),
        (rl.Rule(NON_EMPTY_UNIQUE, "url", mostly=0.5), 5, 1, 1, True, ["u1"]),
        (rl.Rule(NON_EMPTY_UNIQUE, "v"), 5, 1, 0, True, []),
        (rl.Rule(NON_EMPTY_UNIQUE, "id", row_condition="id < 4"), 3, 0, 0, True, []),
    ],
)
def test_rule(df, rule, element, missing, bad, success, sample):
    got = result(df, rule)
    assert (got["element_count"], got["missing_count"], got["unexpected_count"]) == (element, missing, bad)
    assert (got["success"], got["sample"], got["error"]) == (success, sample, None)


def test_plan_rules(df):
    names = ["id", "flag", "url", "tags", "v"]
    assert result(df, rl.Rule(COLUMNS_MATCH, params={"column_list": names}))["success"] is True
    assert result(df, rl.Rule(COLUMNS_MATCH, params={"column_list": names[::-1]}))["success"] is False
    assert result(df, rl.Rule(TYPE_IN_LIST, "id", {"type_list": ["IntegerType"]}))["success"] is True
    assert result(df, rl.Rule(TYPE_IN_LIST, "flag", {"type_list": ["str", "string"]}))["success"] is True
    assert result(df, rl.Rule(TYPE_IN_LIST, "v", {"type_list": ["StringType"]}))["success"] is False


def test_rules_that_cannot_run_fail_alone(df):
    suite = [
        rl.Rule(NOT_NULL, "nowhere"),
        rl.Rule("no_such_rule", "id"),
        rl.Rule(LIST_IN_SET, "flag", {"value_set": ["x"]}),
        rl.Rule(IN_SET, "flag", {}),
        rl.Rule(NOT_NULL, "id", row_condition="nowhere = 1"),
        rl.Rule(COLUMNS_MATCH),
        rl.Rule(NOT_NULL, "id"),
    ]
    got = rl.run_suite(df, suite).orderBy("position").collect()
    assert [r["success"] for r in got] == [False] * 6 + [True]
    assert all(r["error"] for r in got[:6]) and got[6]["error"] is None


@pytest.mark.parametrize("mostly", [-0.1, 1.1, "1", True])
def test_mostly_is_checked_when_built(mostly):
    with pytest.raises(ValueError):
        rl.Rule(NOT_NULL, "id", mostly=mostly)


def test_empty_table_and_empty_suite(spark, df):
    none = df.limit(0)
    suite = [rl.Rule(NOT_NULL, "id"), rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 1}), rl.Rule(NON_EMPTY_UNIQUE, "url")]
    got = rl.run_suite(none, suite).collect()
    assert all(r["success"] and r["element_count"] == 0 and r["unexpected_percent"] == 0 for r in got)
    assert rl.run_suite(df, []).count() == 0
    assert rl.suite_passed(rl.run_suite(df, [])).first()["passed"] is True


def test_suite_from_json_and_fused_equals_single(df):
    text = json.dumps(
        {
            "expectations": [
                {"expectation_type": NOT_NULL, "kwargs": {"column": "flag", "mostly": 0.5}},
                {"expectation_type": IN_SET, "kwargs": {"column": "flag", "value_set": ["A"]}},
                {"expectation_type": NON_EMPTY_UNIQUE, "kwargs": {"column": "url", "max_value": 1, "min_value": 1}},
                {"expectation_type": NON_EMPTY_UNIQUE, "kwargs": {"column": "url", "row_condition": "id = 1"}},
                {"expectation_type": COLUMNS_MATCH, "kwargs": {"column_list": ["id"]}},
            ]
        }
    )
    suite = rl.suite_from_json(text)
    together = rl.run_suite(df, suite).drop("position")
    apart = [rl.run_suite(df, [rule]).drop("position").first() for rule in suite]
    assert values(together) == sorted((tuple(r) for r in apart), key=repr)
    with pytest.raises(ValueError):
        rl.suite_from_json('{"expectations": [{"expectation_type": "x", "kwargs": {"column": "a", "mostly": 2}}]}')


def test_custom_rule_and_unexpected_rows(df):
    rl.register_rule("expect_small", lambda c, p: c > p["limit"])
    rule = rl.Rule("expect_small", "v", {"limit": 2})
    assert result(df, rule)["unexpected_count"] == 2
    assert values(rl.unexpected_rows(df, rule), "v") == [(3.0,), (4.0,)]
    repeats = rl.unexpected_rows(df, rl.Rule(NON_EMPTY_UNIQUE, "url"), ["id"])
    assert values(repeats, "id", "url") == [(2, "u1")]
    assert values(rl.unexpected_values(df, rl.Rule(UNIQUE_PROPORTION, "flag"))) == [("A", 1)]
    with pytest.raises(ValueError):
        rl.unexpected_rows(df, rl.Rule(NON_EMPTY_UNIQUE, "url"))


def test_a_rule_that_fails_on_a_row_fails_alone(df):
    rl.register_rule("expect_number", lambda c, p: c.cast("int") < 0)
    suite = [
        rl.Rule(NOT_NULL, "flag"), rl.Rule(NOT_NULL, "id"), rl.Rule("expect_number", "flag"),
        rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 0.5}), rl.Rule(NOT_NULL, "nowhere"),
    ]
    got = rl.check_suite(df, suite).orderBy("position").collect()
    assert [r["position"] for r in got] == [0, 1, 2, 3, 4]
    assert [r["success"] for r in got] == [False, True, False, True, False]
    assert "CAST_INVALID_INPUT" in got[2]["error"] and got[0]["error"] is None
    sound = suite[:2]
    assert values(rl.check_suite(df, sound)) == values(rl.run_suite(df, sound))
    assert rl.check_suite(df, []).count() == 0


def test_samples_are_bounded(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    got = result(rows, rl.Rule(IN_SET, "s", {"value_set": []}))
    assert got["unexpected_count"] == 1000
    assert got["sample"] == sorted(str(i) for i in range(1000))[:20]
    assert "sample" not in rl.run_suite(rows, [rl.Rule(NOT_NULL, "s")], "summary").columns


MEAN, AT_MOST = "mean_between", "at_most"


@pytest.fixture
def custom_rules(monkeypatch):
    monkeypatch.setattr(quality, "_AGGREGATE_RULES", {})
    monkeypatch.setattr(quality, "_KEYED_RULES", dict(quality._KEYED_RULES))
    rl.register_aggregate_rule(
        MEAN, lambda c, p: {"total": F.sum(c), "n": F.count(c)}, lambda s, p: F.try_divide(s["total"], s["n"]).between(p["low"], p["high"])
    )
    rl.register_keyed_rule(AT_MOST, lambda value, times, p: times > p["times"])


def test_aggregate_rules_share_the_scan_and_show_their_states(spark, custom_rules, plan_of):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (6, "b"), (None, "b")], "v long, k string")
    suite = [
        rl.Rule(MEAN, "v", {"low": 3, "high": 3}), rl.Rule(MEAN, "v", {"low": 0, "high": 1}), rl.Rule(MEAN, "v", {"low": 1, "high": 2}, row_condition="k = 'a'"),
        rl.Rule(MEAN, "v", {"low": 0, "high": 9}, row_condition="k = 'c'"), rl.Rule(NOT_NULL, "v"), rl.Rule(MEAN, "v", {"low": 0}), rl.Rule(MEAN, "no", {}),
    ]
    results = rl.run_suite(df, suite)
    assert values(results, "position", "element_count", "missing_count", "unexpected_count", "success") == [
        (0, 4, 1, None, True), (1, 4, 1, None, False), (2, 2, 0, None, True), (3, 0, 0, None, False), (4, 4, 1, 1, False),
        (5, None, None, None, False), (6, None, None, None, False),
    ]
    assert {r["position"]: r["sample"] for r in results.collect()}[0] == ['{"total":9,"n":3}']
    assert {r["position"]: r["error"] for r in results.collect()}[5] == "KeyError: 'high'"
    assert values(rl.check_suite(df, suite, "summary"), "position", "success") == values(results, "position", "success")
    assert plan_of(rl.run_suite(df, suite[:5], "summary"), "simple").count("Scan") == 1
    with pytest.raises(ValueError):
        rl.unexpected_rows(df, suite[0])


def test_keyed_rules_share_the_count_per_value(spark, custom_rules, plan_of):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "a", "a", "b", "b", "", "", "", "", None, None, None, None])], "n int, k string")
    most = rl.Rule(AT_MOST, "k", {"times": 2})
    suite = [most, rl.Rule(AT_MOST, "k", {"times": 3}, mostly=0.5), rl.Rule(NON_EMPTY_UNIQUE, "k"), rl.Rule(AT_MOST, "k", {"times": 1}, row_condition="n < 4")]
    results = rl.run_suite(df, suite)
    assert values(results, "position", "element_count", "missing_count", "unexpected_count", "success", "sample") == [
        (0, 13, 4, 7, False, ["", "a"]), (1, 13, 4, 4, True, [""]), (2, 13, 4, 3, False, ["a", "b"]), (3, 4, 0, 3, False, ["a"]),
    ]
    assert plan_of(rl.run_suite(df, suite, "summary"), "simple").count("Exchange hashpartitioning") == 1
    assert values(rl.unexpected_values(df, most)) == [("", 4), ("a", 3)]
    assert [r[0] for r in values(rl.unexpected_rows(df, most), "n")] == [0, 1, 2, 5, 6, 7, 8]
    assert [r[0] for r in values(rl.unexpected_rows(df, suite[2], ["n"]), "n")] == [1, 2, 4]


def test_states_of_batches_give_the_results_of_the_table(spark):
    rows = [(i, i % 700, None if i % 9 == 0 else f"t{i}", "" if i % 2 else "x") for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, r long, t string, e string")
    suite = [
        rl.Rule(NOT_NULL, "t", mostly=0.5), rl.Rule(IN_SET, "r", {"value_set": list(range(600))}), rl.Rule(IN_SET, "e", {"value_set": ["x"]}, row_condition="k < 50"),
        rl.Rule(UNIQUE_PROPORTION, "k", {"min_value": 0.9}), rl.Rule(UNIQUE_PROPORTION, "k", {"min_value": 1}), rl.Rule(UNIQUE_PROPORTION, "r", {"min_value": 0.5}),
        rl.Rule(UNIQUE_PROPORTION, "r", {"max_value": 0.5}), rl.Rule(NON_EMPTY_UNIQUE, "r"), rl.Rule(NON_EMPTY_UNIQUE, "t"), rl.Rule(NON_EMPTY_UNIQUE, "t", mostly=0.8),
    ]
    parts = [df.filter(F.col("k") % 7 == i) for i in range(7)] + [df.limit(0)]
    states = [rl.metric_states(p, suite) for p in parts]
    merged = rl.merged_results(functools.reduce(lambda a, b: a.unionByName(b), states), suite)
    exact = {r.position: r for r in rl.run_suite(df, suite, "summary").collect()}
    got = {r.position: r for r in merged.collect()}
    assert got.keys() == exact.keys()
    for position, r in got.items():
        e = exact[position]
        assert (r.rule, r.column, r.element_count, r.missing_count) == (e.rule, e.column, e.element_count, e.missing_count)
        if r.error_bound == 0:
            assert (r.unexpected_count, r.unexpected_percent, r.success) == (e.unexpected_count, e.unexpected_percent, e.success)
        else:
            assert abs(r.unexpected_count - e.unexpected_count) <= r.error_bound * (e.element_count - e.unexpected_count)
            assert r.success is None or r.success == e.success
    # Where the bound does not decide, the result says so.
    assert [got[i].success for i in range(3, 10)] == [True, None, False, True, False, None, True]
    with pytest.raises(ValueError):
        rl.metric_states(df, [rl.Rule(COLUMNS_MATCH, params={"column_list": []})])


def test_states_of_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "k long")
    suite = [rl.Rule(NOT_NULL, "k"), rl.Rule(UNIQUE_PROPORTION, "k", {"min_value": 1}), rl.Rule(NON_EMPTY_UNIQUE, "k")]
    assert values(rl.merged_results(rl.metric_states(df, suite), suite), "element_count", "unexpected_count", "success") == [(0, 0, True)] * 3


def test_row_rules_are_counted_while_the_candidate_is_written(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, "AB"[i % 2] if i % 5 else None, ["x"] if i % 3 else None) for i in range(100)], "id int, flag string, tags array<string>")
    suite = [
        rl.Rule(NOT_NULL, "id"), rl.Rule(NOT_NULL, "flag", mostly=0.5), rl.Rule(IN_SET, "flag", {"value_set": ["A"]}), rl.Rule(IS_LIST, "tags", mostly=0.9),
        rl.Rule(LIST_IN_SET, "tags", {"value_set": ["x"]}), rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 1}), rl.Rule(IN_SET, "id", {"value_set": [1]}, row_condition="id < 2"),
        rl.Rule(NOT_NULL, "no_such"), rl.Rule(COLUMNS_MATCH, params={"column_list": ["id", "flag", "tags"]}),
    ]
    asked = []
    plain = quality._row_results
    monkeypatch.setattr(quality, "_row_results", lambda df, rules: asked.extend(p for p, _ in rules) or plain(df, rules))
    want = {d: values(rl.check_suite(df, suite, d)) for d in ("summary", "basic", "complete")}
    columns = {d: rl.check_suite(df, suite, d).columns for d in want}
    for detail, expected in want.items():
        asked.clear()
        got = rl.promote_if_valid(df, suite, lambda _: None, str(tmp_path / detail), detail)
        assert values(got.select(columns[detail])) == expected
        # Only rules that failed are looked at again, for their samples.
        assert set(asked) >= {6} and not set(asked) & {0, 4}
    assert len(want["complete"][2][-1]) == 40 and len(want["basic"][2][-1]) == 20
    # Counts that do not belong to the table are not used.
    watched = quality.WatchedRules(df, suite)
    watched.frame.write.parquet(str(tmp_path / "again"))
    assert watched.results(df.limit(3)) is None and watched.results(spark.read.parquet(str(tmp_path / "again"))).count() == 5
    assert [p for p, _ in watched.rest] == [5, 6, 7, 8]


def test_all_bad_values_are_a_table(df, spark):
    suite = [rl.Rule(NOT_NULL, "flag"), rl.Rule(IN_SET, "flag", {"value_set": ["B"]}), rl.Rule(UNIQUE_PROPORTION, "id", {"min_value": 1}), rl.Rule(NON_EMPTY_UNIQUE, "url"),
             rl.Rule(LIST_IN_SET, "tags", {"value_set": ["x"]}), rl.Rule(NOT_NULL, "no_such")]
    assert values(rl.bad_values(df, suite)) == sorted(
        [(1, IN_SET, "flag", "A"), (1, IN_SET, "flag", "A"), (1, IN_SET, "flag", "Z"), (2, UNIQUE_PROPORTION, "id", "4"), (3, NON_EMPTY_UNIQUE, "url", "u1"),
         (4, LIST_IN_SET, "tags", '["x","q"]'), (4, LIST_IN_SET, "tags", '["y",null]')], key=repr)
    for none in ([], [rl.Rule(NOT_NULL, "no_such")]):
        assert rl.bad_values(df, none).columns == ["position", "rule", "column", "value"] and rl.bad_values(df, none).count() == 0
