"""Readers and writers."""

from .ranges import create_master, latest_version, merge_master, read_master
from .readers import (
    latest_batch,
    latest_file,
    read_csv_records,
    read_inbox,
    read_json_records,
)
from .sinks import (
    append_rejects,
    append_review,
    promote_if_valid,
    publish_if_valid,
    store_results,
    store_states,
    write_all,
    write_csv_records,
    write_json_records,
)
