"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads, ``BENCH_RUNS``
the timed runs per query (median, after one warm-up). Results go to the
``noop`` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import QUERIES  # noqa: E402
from recordloom import configure  # noqa: E402

HEADLINE = [
    "incremental_since_month_start",
    "explode_references",
    "extract_doi",
    "doi_from_pages",
    "fill_dois",
    "clean_labels",
    "rebuild_text",
    "map_labels",
    "map_labels_large_map",
    "convert_taxonomy",
    "combine",
    "first_per_key",
    "last_per_key",
    "assign_sequential_ids",
    "upsert_update",
    "upsert_repeated_master",
    "upsert_insert",
    "upsert",
    "enrich_works",
    "to_record",
    "rule_mostly_and_condition",
    "rule_unique_proportion",
    "run_suite",
    "unexpected_rows",
    "unexpected_values",
    "quarantine_good",
    "csv_round_trip",
    "json_round_trip",
    "ingest_inbox",
    "curation_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or [q for q in HEADLINE if q in QUERIES]
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recordloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
