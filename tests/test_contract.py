"""The driver contract on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
FAST = [
    "incremental_since_month_start", "explode_references", "fill_dois", "map_labels", "map_labels_large_map",
    "combine", "last_per_key", "assign_sequential_ids", "upsert", "upsert_repeated_master", "enrich_works",
    "to_record", "run_suite", "unexpected_repeats", "quarantine_rejects", "csv_round_trip", "ingest_inbox", "curation_full",
]


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_agrees_with_sql(spark, name):
    problem = compare(spark, connect(SF), SF, name, contract.queries()[name], contract.oracle_sql()[name])
    assert problem is None
