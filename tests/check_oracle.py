"""Compare the registered queries with their SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def compare(spark, db, sf_dir, name, fn, sql):
    """None if both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    if sql is None:
        return None
    cursor = db.execute(sql)
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got[1] != want[1]:
        extra, missing = set(map(repr, got[1])) - set(map(repr, want[1])), set(map(repr, want[1])) - set(map(repr, got[1]))
        show = [x[:600] for x in sorted(extra)[:2]], [x[:600] for x in sorted(missing)[:2]]
        return f"rows {len(got[1])} / {len(want[1])}: spark {show[0]} sql {show[1]}"
    return None if got[1] else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), []
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, db, sf_dir, name, contract.queries()[name], contract.oracle_sql().get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(wanted) - len(failed)}/{len(wanted)} agree; failed: {failed}")
