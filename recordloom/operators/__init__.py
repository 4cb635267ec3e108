"""Operators on whole frames."""

from .combine import combine
from .enrich import (
    doi_from_pages,
    enrich_works,
    fill_dois,
    record_checks,
    to_record,
    works_by_key,
)
from .keys import (
    assign_sequential_ids,
    first_per_key,
    last_per_key,
    lookup_join,
    next_key,
)
from .metrics import merged_results, metric_states
from .quality import (
    Rule,
    bad_values,
    check_suite,
    register_aggregate_rule,
    register_keyed_rule,
    register_rule,
    run_suite,
    suite_from_json,
    suite_passed,
    unexpected_rows,
    unexpected_values,
)
from .routing import quarantine, route_by_flag
from .shaping import (
    col_or_default,
    conform,
    drop_missing,
    explode_references,
    fill_missing,
    first_present,
    incremental_since_month_start,
    month_start,
    sort_records,
    source_links,
    with_constants,
    with_post_labels,
)
from .taxonomy import convert_taxonomy, load_label_map, map_labels
from .upsert import new_rows, update_master, upsert
