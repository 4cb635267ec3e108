import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

import recordloom as rl
from conftest import values
from recordloom.operators.quality import IN_SET, NOT_NULL
from recordloom.sources import ranges
from recordloom.sources.readers import latest_file

SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
    ]
)
ROWS = [
    (1, 'quote " and, comma', ["a", "b's"], 0.5),
    (2, " two\nlines ", [], None),
    (3, None, ["it's", 'x"y'], 1.0),
    (4, "", None, 2.5),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_csv_round_trip(spark, df, tmp_path):
    path = str(tmp_path / "csv")
    rl.write_csv_records(df, path)
    back = rl.read_csv_records(spark, path, SCHEMA)
    expected = [(r[0], r[1] or None, r[2] or [], r[3]) for r in ROWS]  # CSV has no blanks
    assert values(back) == sorted(expected, key=repr)


def test_json_round_trip_and_framed_array(spark, df, tmp_path):
    path = str(tmp_path / "json")
    rl.write_json_records(df, path)
    assert values(rl.read_json_records(spark, path, SCHEMA)) == values(df)
    framed = tmp_path / "framed.json"
    framed.write_text('[\n\t{"record_id": 1, "title": "a, ]"},\n\t{"record_id": "", "title": "b"}\n]')
    back = rl.read_json_records(spark, str(framed), SCHEMA)
    assert values(back, "record_id", "title") == [(1, "a, ]"), (None, "b")]
    assert values(rl.read_json_records(spark, str(framed), SCHEMA, multi_line=True), "title") == [("a, ]",), ("b",)]


@pytest.mark.parametrize("layout", ["lines", "one line", "framed", "indented"])
def test_json_arrays_in_every_layout(spark, tmp_path, layout):
    records = [{"record_id": i, "title": t} for i, t in ((1, "a, ]"), (2, "b\n["), (3, None))]
    lines = [json.dumps(r) for r in records]
    text = {
        "lines": "\n".join(lines), "one line": json.dumps(records), "framed": "[\n" + ",\n".join(lines) + "\n]",
        "indented": json.dumps(records, indent=2),
    }[layout]
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text(json.dumps(records[0]))
    want = sorted([*[(r["record_id"], r["title"]) for r in records], (1, "a, ]")], key=repr)
    assert values(rl.read_json_records(spark, str(tmp_path), SCHEMA), "record_id", "title") == want
    (tmp_path / "c.csv").write_text("title,record_id\nx,4\n")
    inbox = rl.read_inbox(spark, str(tmp_path), SCHEMA)
    assert values(inbox, "record_id", "title") == sorted([*want, (4, "x")], key=repr)
    assert {r[0] for r in values(inbox, "source_file")} == {"a.json", "b.json", "c.csv"}


def test_a_text_that_is_no_record_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"record_id": 1}\nnonsense\n')
    with pytest.raises(Exception, match="not a JSON record"):
        rl.read_json_records(spark, str(tmp_path), SCHEMA).collect()


def test_unreadable_json_lines_are_kept(spark, tmp_path):
    file = tmp_path / "bad.json"
    file.write_text('{"record_id": 1}\n{"record_id": 2, "title": "cut\n')
    schema = T.StructType(SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    back = rl.read_json_records(spark, str(file), schema)
    assert values(back, "record_id", "_corrupt_record") == [(1, None), (None, '{"record_id": 2, "title": "cut')]


def test_inbox_reads_files_with_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('record_id,title,labels\n1,"x, y","[\'p\', ""q""]"\n')
    (tmp_path / "b.csv").write_text("score,extra,title\n0.5,e,second\n")
    (tmp_path / "c.csv").write_text("score,extra,title\nbad,e,third\n")
    (tmp_path / "merged.csv").write_text("title\nold\n")
    (tmp_path / "d.json").write_text('{"title": "fourth", "labels": ["z"]}\n')
    (tmp_path / "note.txt").write_text("ignored")
    out = rl.read_inbox(spark, str(tmp_path), SCHEMA, exclude="merged.csv")
    assert out.columns == ["record_id", "title", "labels", "score", "source_file"]
    assert values(out) == sorted(
        [
            (1, "x, y", ["p", "q"], None, "a.csv"),
            (None, "second", None, 0.5, "b.csv"),
            (None, "third", None, None, "c.csv"),
            (None, "fourth", ["z"], None, "d.json"),
        ],
        key=repr,
    )


def test_inbox_stream_takes_each_file_once(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))
    os.makedirs(inbox)
    header = "record_id,title,labels,score\n"
    (tmp_path / "inbox" / "a.csv").write_text(header + '1,"two\nlines","[\'p\']",0.5\n')
    (tmp_path / "inbox" / "b.json").write_text('{"record_id": 2, "title": "j"}\n')
    rl.ingest_inbox(spark, inbox, table, state, SCHEMA)
    rl.ingest_inbox(spark, inbox, table, state, SCHEMA)
    assert values(rl.ingested(spark, table), "record_id", "source_file") == [(1, "a.csv"), (2, "b.json")]
    (tmp_path / "inbox" / "c.csv").write_text(header + "3,late,,\n")
    rl.ingest_inbox(spark, inbox, table, state, SCHEMA)
    assert values(rl.ingested(spark, table), "record_id", "title") == [(1, "two\nlines"), (2, "j"), (3, "late")]


LISTS = T.StructType(SCHEMA.fields + [T.StructField("shares", T.ArrayType(T.DoubleType()))])


def entries(df):
    return values(df.select("record_id", "error_reason", F.inline("_rescued")))


def test_what_a_csv_file_loses_is_rejected_with_file_and_reason(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,title,labels\n1,\"x\ny\",\"['p']\"\n2x,t,\"['open\"\na,1,zzz\n3,short\n4,long,[],more\n\n5,, \n")
    (tmp_path / "b.csv").write_text("title,score,shares\nu,1.5,\"[1, None, 2]\"\nv, ,\"[1, 'x']\"\nw,1.5.1,\n")
    rows = rl.read_inbox(spark, str(tmp_path), LISTS, rescue=True)
    good, rejects = rl.quarantine(rows, {"title is u": F.col("title") == "u"})
    assert values(good, "record_id", "title", "labels") == [(1, "x\ny", ["p"]), (5, None, [])]
    assert good.columns == [*LISTS.names, "source_file"]
    whole = "not as many fields as the header"
    assert entries(rejects) == sorted(
        [
            (None, "record_id is not a bigint", "a.csv", "record_id", "2x", "not a bigint"),
            (None, "record_id is not a bigint", "a.csv", "labels", "['open", "not a list"),
            (None, "record_id is not a bigint", "a.csv", "record_id", "a", "not a bigint"),
            (None, "record_id is not a bigint", "a.csv", "labels", "zzz", "not a list"),
            (3, whole, "a.csv", None, "3,short", whole),
            (4, whole, "a.csv", None, "4,long,[],more", whole),
            (None, "shares is not a list", "b.csv", "shares", "[1, 'x']", "not a list"),
            (None, "score is not a double", "b.csv", "score", "1.5.1", "not a double"),
        ],
        key=repr,
    )
    assert values(rejects.filter("title = 'u'"), "error_reason", "_rescued") == [("title is u", [])]
    assert rejects.filter("size(_rescued) > 0").count() == 6
    # Without a type to lose anything to, only the length of lines is looked at.
    (tmp_path / "c.csv").write_text("title\nx\ny,z\n")
    texts = T.StructType([T.StructField("title", T.StringType())])
    assert rl.read_csv_records(spark, str(tmp_path / "c.csv"), texts, rescue=True).filter("size(_rescued) > 0").count() == 1


def test_what_a_json_file_loses_is_rejected_with_file_and_reason(spark, tmp_path):
    lines = ['{"record_id": 7, "title": "j", "labels": ["a", null], "shares": [1, 2.5]}', '{"record_id": "8", "title": 5, "labels": "zz"}']
    lines += ["nonsense", '{"record_id": {"a":1}, "shares": [1,"q"]}', '{"record_id": 2, "title": "cut', "{}"]
    (tmp_path / "c d.json").write_text("\n".join(lines))
    (tmp_path / "e.json").write_text('[\n {"record_id": 9,\n  "score": "no"},\n {"record_id": 10, "labels": []}]')
    rows = rl.read_json_records(spark, str(tmp_path), LISTS, rescue=True)
    good, rejects = rl.quarantine(rows, {})
    assert values(good, "record_id", "labels", "shares") == [(10, [], []), (7, ["a", None], [1.0, 2.5]), (None, [], [])]
    assert entries(rejects) == sorted(
        [
            (8, "labels is not a list", "c d.json", "labels", "zz", "not a list"),
            (None, "not a JSON record", "c d.json", None, "nonsense", "not a JSON record"),
            (None, "not a JSON record", "c d.json", None, '{"record_id": 2, "title": "cut', "not a JSON record"),
            (None, "record_id is not a bigint", "c d.json", "record_id", '{"a":1}', "not a bigint"),
            (None, "record_id is not a bigint", "c d.json", "shares", '[1,"q"]', "not a list"),
            (9, "score is not a double", "e.json", "score", "no", "not a double"),
        ],
        key=repr,
    )
    with pytest.raises(ValueError):
        rl.read_json_records(spark, str(tmp_path), LISTS, multi_line=True, rescue=True)


def test_rows_are_ordered_as_they_arrived(spark, tmp_path):
    """By time of the file, then within it; the name of a file does not matter."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for at, (name, text) in enumerate([("z.csv", "record_id,title\n1,a\n2,a\n1,b\n"), ("m.json", '{"record_id": 2, "title": "c"}\n{"record_id": 3, "title": "c"}\n'),
                                       ("a.csv", "title,record_id\nd,3\n" + "".join(f"x{i},4\n" for i in range(500)))]):
        (inbox / name).write_text(text)
        os.utime(inbox / name, (1_700_000_000 + at, 1_700_000_000 + at))
    rows = rl.read_inbox(spark, str(inbox), SCHEMA, arrival=True)
    last = rl.last_per_key(rows.repartition(3), ["record_id"], ["_arrival"])
    assert values(last, "record_id", "title") == [(1, "b"), (2, "c"), (3, "d"), (4, "x499")]
    assert values(rl.first_per_key(rows, ["record_id"], ["_arrival"]), "record_id", "title") == [(1, "a"), (2, "a"), (3, "c"), (4, "x0")]
    master = spark.createDataFrame([(1, "old"), (9, "kept")], "record_id long, title string")
    merged = rl.upsert(master, rows.select("record_id", "title", "_arrival"), "record_id", ["_arrival"])
    assert merged.columns == ["record_id", "title"]
    got = {r.record_id: r.title for r in merged.collect()}
    assert [got[i] for i in (1, 9, 10, 11, 12, 13, 14)] == ["b", "kept", "a", "c", "c", "d", "x0"] and len(got) == 2 + 504


def test_the_stream_takes_files_of_any_layout(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))
    os.makedirs(inbox)
    (tmp_path / "inbox" / "a.csv").write_text("record_id,title\n1,one\n")
    (tmp_path / "inbox" / "b.csv").write_text("score,title\n0.5,two\nbad,three\n")
    (tmp_path / "inbox" / "c.json").write_text(json.dumps([{"record_id": 3, "labels": ["l"]}, {"record_id": 4}], indent=2))
    (tmp_path / "inbox" / "d.json").write_text('{"record_id": 5}\nbroken\n{"record_id": 6}\n')
    (tmp_path / "inbox" / "e.txt").write_text("not taken")
    rl.ingest_inbox(spark, inbox, table, state, SCHEMA, max_files=3)
    rows = rl.ingested(spark, table)
    assert values(rows, "record_id", "title", "score") == sorted(
        [(1, "one", None), (None, "two", 0.5), (None, "three", None), (3, None, None), (4, None, None), (5, None, None), (None, None, None), (6, None, None)],
        key=repr,
    )
    assert values(rows.select(F.inline("_rescued")), "file", "raw") == [("b.csv", "bad"), ("d.json", "broken")]
    assert {r[0] for r in values(rows, "batch_id")} == {0, 1}
    with pytest.raises(ValueError):
        rl.ingest_inbox(spark, inbox, table, state, SCHEMA, ("xml",))


def test_a_batch_that_failed_comes_again_and_leaves_one_copy(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))
    os.makedirs(inbox)
    (tmp_path / "inbox" / "a.csv").write_text("record_id\n1\n2\n")
    seen = []

    def handle(paths, batch):
        seen.append((batch, [os.path.basename(p) for p in paths]))
        rl.read_inbox(spark, paths, SCHEMA).write.mode("overwrite").parquet(f"{table}/batch_id={batch}")
        if len(seen) == 1:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        rl.take_files(spark, inbox, state, handle)
    (tmp_path / "inbox" / "b.csv").write_text("title\nlate\n")
    rl.take_files(spark, inbox, state, handle)
    rl.take_files(spark, inbox, state, handle)
    assert seen == [(0, ["a.csv"]), (0, ["a.csv"]), (1, ["b.csv"])]
    assert values(rl.ingested(spark, table), "record_id", "title", "batch_id") == [(1, None, 0), (2, None, 0), (None, "late", 1)]


def test_a_run_that_comes_again_replaces_what_it_stored(spark, df, tmp_path):
    path = str(tmp_path / "review")
    rl.append_review(df, path, "r1")
    rl.append_review(df.limit(2), path, "r2")
    rl.append_review(df.limit(3), path, "r1")
    assert values(spark.read.parquet(path).groupBy("run_id").count()) == [("r1", 3), ("r2", 2)]


def test_latest_batch_and_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-03"), (3, "2024-03"), (4, None)], "id int, batch string")
    assert values(rl.latest_batch(df, "batch"), "id") == [(2,), (3,)]
    for name, n in (("b1.json", 1), ("b2.json", 2)):
        (tmp_path / name).write_text('{"n": %d}\n' % n)
    read = spark.read.schema("n int").json(str(tmp_path))
    assert values(latest_file(read)) == [(2,)]


def test_review_and_results_are_appended_by_run(spark, df, tmp_path):
    path = str(tmp_path / "review")
    rl.append_review(df, path, "r1")
    rl.append_review(df.limit(0), path, "r2")
    rl.append_review(df.limit(1), path, "r3")
    assert {d for d in os.listdir(path) if d.startswith("run_id")} == {"run_id=r1", "run_id=r3"}
    results = rl.run_suite(df, [rl.Rule(NOT_NULL, "title")])
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    rl.store_results(results, str(tmp_path / "results"), "r1", at)
    rl.store_results(results, str(tmp_path / "results"), "r2", at)
    stored = spark.read.parquet(str(tmp_path / "results"))
    assert values(stored, "run_id", "unexpected_count") == [("r1", 1), ("r2", 1)]


@pytest.mark.parametrize("allowed, published", [([1, 2, 3, 4], True), ([1, 2], False)])
def test_gate_publishes_only_what_passes(spark, df, tmp_path, allowed, published):
    seen = []
    suite = [rl.Rule(NOT_NULL, "record_id"), rl.Rule(IN_SET, "record_id", {"value_set": allowed})]
    candidate = str(tmp_path / "candidate")
    results = rl.promote_if_valid(df, suite, lambda ok: seen.append(ok.count()), candidate)
    assert seen == ([4] if published else [])
    assert spark.read.parquet(candidate).count() == 4
    assert [r["success"] for r in results.orderBy("position").collect()] == [True, published]


def test_write_all_computes_once(spark, df, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    counted = F.udf(lambda x: calls.add(1) or x, "bigint").asNondeterministic()
    seen = df.withColumn("record_id", counted("record_id"))
    rl.write_all(seen, lambda d: rl.write_csv_records(d, a), lambda d: rl.write_json_records(d, b))
    assert rl.read_csv_records(spark, a, SCHEMA).count() == rl.read_json_records(spark, b, SCHEMA).count() == 4
    assert calls.value == 4 and not seen.is_cached


def test_shared_dir_comes_from_the_session(spark, monkeypatch, tmp_path):
    assert rl.scratch_path(spark, "x") != rl.scratch_path(spark, "x")
    named = str(tmp_path / "named")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: named)
    assert rl.shared_dir(spark) == named
    assert rl.scratch_path(spark, "x").startswith(named + "/x-")


def test_a_cluster_without_a_shared_dir_is_refused():
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        rl.shared_dir(Session())


def test_a_merge_writes_only_the_ranges_it_touches(spark, tmp_path):
    path = str(tmp_path / "master")
    rows = [(i, f"t{i}", None) for i in range(1, 96)] + [(None, "no key", "x")]
    rl.create_master(spark.createDataFrame(rows, "k long, t string, u string"), path, "k", width=10)
    folders = lambda v: sorted(d for d in os.listdir(f"{path}/data/version={v}") if d.startswith("range"))
    assert len(folders(0)) == 11
    updates = [(23, "late", 2, "a"), (23, "early", 1, "b"), (500, "unknown", 3, "c"), (None, "new", 4, "d"), (47, None, 5, "e")]
    df = spark.createDataFrame(updates, "k long, t string, o int, extra string")
    assert rl.merge_master(spark, path, df, "k", ["o"]) == 1
    assert folders(1) == ["range=2", "range=4", "range=9"]
    want = {i: (f"t{i}", None) for i in range(1, 96)} | {None: ("no key", None), 23: ("late", "a"), 47: (None, "e"), 96: ("unknown", "c"), 97: ("new", "d")}
    assert {r.k: (r.t, r.extra) for r in rl.read_master(spark, path).collect()} == want
    whole = rl.upsert(rl.read_master(spark, path, 0), df, "k", ["o"])
    assert values(rl.read_master(spark, path).select(*whole.columns)) == values(whole)
    # The same merge again replaces its version, the next one builds on it, older ones stay.
    assert rl.merge_master(spark, path, df, "k", ["o"], base=0) == 1
    assert {r.k: (r.t, r.extra) for r in rl.read_master(spark, path).collect()} == want
    assert rl.merge_master(spark, path, df.filter("k is null"), "k", ["o"]) == 2
    assert folders(2) == ["range=9"] and rl.read_master(spark, path).count() == 99
    assert values(rl.read_master(spark, path, 0), "k", "t") == sorted([(k, t) for k, t, _ in rows], key=repr)
    none = df.limit(0)
    assert rl.merge_master(spark, path, none, "k", ["o"]) == 3 and rl.read_master(spark, path).count() == 99


def test_only_touched_ranges_are_read(spark, tmp_path, plan_of):
    path = str(tmp_path / "master")
    rl.create_master(spark.range(1000).selectExpr("id AS k", "id AS v"), path, "k", width=10)
    lines, _ = ranges._lines(spark, path, 0)
    some = ranges._rows_of(spark, path, [x for x in lines if x["range"] in (3, 50)], T.StructType.fromDDL("k long, v long"))
    assert sorted(r.k for r in some.collect()) == [*range(30, 40), *range(500, 510)]
    assert "PartitionFilters" in plan_of(some) and len(some.inputFiles()) <= 101
    files = some.select(F.input_file_name()).distinct().count()
    assert files == 2


def test_a_master_without_rows_takes_the_first(spark, tmp_path):
    path = str(tmp_path / "master")
    rl.create_master(spark.createDataFrame([], "k long, t string"), path, "k")
    rl.merge_master(spark, path, spark.createDataFrame([(7, "a", 1), (None, "b", 2)], "k long, t string, o int"), "k", ["o"])
    assert values(rl.read_master(spark, path)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        rl.create_master(spark.createDataFrame([], "k long"), path, "k", width=0)


def test_scratch_tables_are_removed(spark):
    before = rl.scratch_mark(spark)
    a, b, c = (rl.scratch_path(spark, n) for n in "abc")
    for path in (a, b):
        spark.range(3).write.parquet(path)
    mark = rl.scratch_mark(spark)
    assert mark == before + 3 and rl.clear_scratch(spark, mark) == 0
    local = lambda p: os.path.exists(p.removeprefix("file:"))
    assert rl.clear_scratch(spark, before, keep=(b,)) == 1 and not local(a) and local(b)
    assert rl.scratch_mark(spark) == before + 1 and rl.clear_scratch(spark, before) == 1 and not local(b)
