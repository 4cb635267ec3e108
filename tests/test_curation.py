import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import recordloom as rl
from conftest import values
from recordloom.operators.quality import COLUMNS_MATCH, NON_EMPTY_UNIQUE, NOT_NULL, UNIQUE_PROPORTION
from recordloom.schemas import POST_SCHEMA, RECORD_SCHEMA, WORK_SCHEMA, record_schema

SUITE = [
    rl.Rule(NOT_NULL, "record_id"),
    rl.Rule(UNIQUE_PROPORTION, "record_id", {"min_value": 1, "max_value": 1}),
    rl.Rule(NON_EMPTY_UNIQUE, "url"),
]
MAP_SCHEMA = "`Level I` string, `Level II` string, `Level III` string, `Alevel I` string, `Alevel II` string, `Alevel III` string"


def post(kind, day, label, *links):
    levels = (["a"], ["a > b"], [f"a > b > {label}"])
    return (kind, dt.datetime(2024, 5, day), (levels,), None, (list(links),))


@pytest.fixture(scope="module")
def inputs(spark):
    posts = [
        post("S", 2, "Keep me", "http://one", "http://two"),
        post("S", 3, "Ask me", "http://ask"),
        post("T", 3, "Keep me", "http://other-type"),
        ("S", dt.datetime(2024, 4, 30), ((["a"], ["a > b"], ["a > b > Keep me"]),), None, (["http://old"],)),
    ]
    works = spark.createDataFrame([], WORK_SCHEMA)
    one = [("https://openalex.org/W1", "https://doi.org/10.1000/x", "Found")]
    works = rl.conform(spark.createDataFrame(one, "id string, doi string, title string"), WORK_SCHEMA)
    master = spark.createDataFrame([(5, "http://kept", "kept"), (6, "http://six", "six")], "record_id long, url string, title string")
    inbox = spark.createDataFrame(
        [("6", "http://six-new", "['L 1']", "s"), ("", "http://new", "['open", "bad"), (None, None, None, "no url")],
        "record_id string, url string, label_level_3 string, title string",
    )
    return rl.CurationInputs(
        works=works,
        master=rl.conform(master, RECORD_SCHEMA),
        inbox=[inbox],
        posts=spark.createDataFrame(posts, POST_SCHEMA),
        pages=spark.createDataFrame([("http://one", '<a href="https://doi.org/10.1000%x">d</a>')], "url string, html string"),
        label_map=spark.createDataFrame([("T", "M", "KEEP", None, None, "Keep me"), (None, None, "MANUAL LABEL", None, None, "Ask me")], MAP_SCHEMA),
        as_of=dt.datetime(2024, 5, 20),
        post_type="S",
    )


def test_full_run(spark, inputs, tmp_path):
    published = []
    run = rl.run_curation(inputs, str(tmp_path / "run"), SUITE, lambda df: published.append(df.count()))
    assert run.candidate.columns == RECORD_SCHEMA.names
    assert values(run.candidate, "record_id", "url", "title", "doi", "level3") == sorted(
        [
            (5, "http://kept", "kept", None, None),
            (6, "http://six-new", "s", "", ["l_1"]),
            (7, "http://one", "Found", "10.1000/X", ["keep_me"]),
            (8, "http://two", "", "", ["keep_me"]),
        ],
        key=repr,
    )
    assert values(run.review, "url", "ask_label_level_3") == [("http://ask", ["ask me"])]
    assert values(run.rejects, "url", "error_reason") == [("http://new", "label_level_3 is not a list")]
    assert published == [4]


def test_another_key_name(spark, inputs, tmp_path):
    from dataclasses import replace

    renamed = replace(
        inputs,
        master=inputs.master.withColumnRenamed("record_id", "myID"),
        inbox=[df.withColumnRenamed("record_id", "myID") for df in inputs.inbox],
    )
    suite = [rl.Rule(COLUMNS_MATCH, params={"column_list": record_schema("myID").names}), rl.Rule(NOT_NULL, "myID")]
    run = rl.run_curation(renamed, str(tmp_path / "run"), suite, lambda df: None, start="combine", key="myID")
    assert values(run.candidate, "myID", "url") == [(5, "http://kept"), (6, "http://six-new")]
    assert rl.suite_passed(run.results).first()["passed"] is True


def test_merge_only_run_and_failed_gate(spark, inputs, tmp_path):
    suite = SUITE + [rl.Rule(NOT_NULL, "abstract")]
    published = []
    run = rl.run_curation(inputs, str(tmp_path / "run"), suite, published.append, start="combine")
    assert run.review is None and published == []
    assert values(run.candidate, "record_id", "url") == [(5, "http://kept"), (6, "http://six-new")]
    assert rl.suite_passed(run.results).first()["passed"] is False
    again = rl.run_suite(run.candidate, SUITE)
    assert rl.suite_passed(again).first()["passed"] is True
    with pytest.raises(ValueError):
        rl.run_curation(inputs, str(tmp_path / "x"), suite, published.append, start="middle")


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


def write_at(folder, name, text, at):
    (folder / name).write_text(text)
    os.utime(folder / name, (1_700_000_000 + at, 1_700_000_000 + at))


def stored(spark, root, name, *columns):
    return values(spark.read.parquet(f"{root}/{name}"), "run_id", *columns)


def test_batches_of_an_inbox_go_into_master_and_stores(spark, inputs, inbox, tmp_path):
    root = str(tmp_path / "root")

    def run(suite=SUITE):
        return rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, suite)

    write_at(inbox, "b.csv", "record_id,url,title,label_level_1\n6,http://six-b,b,\"['L 1']\"\n,http://new,n,\"['open\"\n,http://fresh,f,[]\n", 1)
    write_at(inbox, "a.json", '{"record_id": 6, "url": "http://six-a", "title": "a"}\n{"title": "no url"}\n', 2)
    write_at(inbox, "c.csv", "url,doi\nhttp://one,10.1000/x\n", 3)
    want = [(5, "http://kept", "kept"), (6, "http://six-a", "a"), (7, "http://fresh", "f"), (8, "http://one", "Found")]
    assert values(run(), "record_id", "url", "title") == want
    assert rl.master_version(spark, root) == 0
    rejects = [("batch-0", "http://new", "label_level_1 is not a list")]
    assert stored(spark, root, "rejects", "url", "error_reason") == rejects
    assert values(spark.read.parquet(f"{root}/rejects").select(F.inline("_rescued")), "file", "raw") == [("b.csv", "['open")]
    # Nothing new changes nothing.
    assert values(run(), "record_id", "url", "title") == want and len(stored(spark, root, "results", "rule")) == 3

    write_at(inbox, "d.json", '[\n  {"record_id": 7,\n   "url": "http://fresh-2"},\n  {"record_id": "x7", "url": "http://bad"}]', 4)
    later = [*want[:2], (7, "http://fresh-2", None), want[3]]
    assert values(run(), "record_id", "url", "title") == sorted(later, key=repr)
    both = [*rejects, ("batch-1", "http://bad", "record_id is not a bigint")]
    assert stored(spark, root, "rejects", "url", "error_reason") == both
    assert rl.master_version(spark, root) == 1 and rl.master_version(spark, root, before=1) == 0


def test_a_batch_that_is_run_twice_changes_nothing(spark, inputs, inbox, tmp_path, monkeypatch):
    root, calls = str(tmp_path / "root"), []
    curation = rl.plans.curation
    whole = curation.run_curation

    def lost(*args, **kwargs):
        calls.append(kwargs["run_id"])
        done = whole(*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("lost behind the last write")
        return done

    monkeypatch.setattr(curation, "run_curation", lost)
    write_at(inbox, "a.csv", "url,label_level_1\nhttp://a,[]\nhttp://b,['\n", 1)
    rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, SUITE)
    write_at(inbox, "b.csv", "url,label_level_1\nhttp://c,[]\nhttp://d,['\n", 2)
    with pytest.raises(Exception, match="lost behind"):
        rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, SUITE)
    newest = rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, SUITE)
    assert calls == ["batch-0", "batch-1", "batch-1"]
    assert values(newest, "record_id", "url") == [(5, "http://kept"), (6, "http://six"), (7, "http://a"), (8, "http://c")]
    assert stored(spark, root, "rejects", "url") == [("batch-0", "http://b"), ("batch-1", "http://d")]
    assert len(stored(spark, root, "results", "rule")) == 6


def test_source_labels_of_the_inbox_are_converted_and_reviewed(spark, inputs, inbox, tmp_path):
    root = str(tmp_path / "root")
    write_at(inbox, "a.csv", "url,label_level_3\nhttp://a,\"['Keep me']\"\nhttp://b,\"['Ask me']\"\n", 1)
    newest = rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, SUITE, label_map=inputs.label_map)
    assert values(newest.filter("record_id > 6"), "url", "level1", "level3") == [("http://a", ["t"], ["keep_me"])]
    assert stored(spark, root, "review", "url") == [("batch-0", "http://b")]


def test_a_failed_batch_is_corrected_and_validated_again(spark, inputs, inbox, tmp_path):
    root, published = str(tmp_path / "root"), []
    strict = [*SUITE, rl.Rule(NOT_NULL, "title")]
    write_at(inbox, "a.csv", "url,title\nhttp://a,\n", 1)
    assert values(rl.run_inbox(spark, str(inbox), root, inputs.works, inputs.master, strict), "record_id") == [(5,), (6,)]
    assert rl.master_version(spark, root) is None
    candidate = f"{root}/batches/0/candidate"
    corrected = spark.read.parquet(candidate).fillna("corrected", ["title"])
    corrected.write.parquet(str(tmp_path / "by-hand"))
    spark.read.parquet(str(tmp_path / "by-hand")).write.mode("overwrite").parquet(candidate)
    run = rl.run_curation(inputs, f"{root}/batches/0", strict, lambda df: published.append(df.count()), start="validate", stores=root, run_id="again")
    assert published == [3] and run.rejects is None and values(run.candidate, "record_id", "title")[-1] == (7, "corrected")
    verdicts = spark.read.parquet(f"{root}/results").groupBy("run_id").agg(F.bool_and("success"))
    assert values(verdicts) == [("again", True), ("batch-0", False)]
    with pytest.raises(ValueError):
        rl.run_curation(inputs, f"{root}/batches/0", strict, published.append, start="validate", stores=root)
