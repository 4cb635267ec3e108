"""Column functions."""

from .identifiers import (
    bad_work_id,
    doi_from_url,
    doi_link,
    doi_of_link,
    extract_doi,
    extract_work_id,
    is_blank,
    page_links,
    to_key,
)
from .lists import (
    access_fields,
    append_missing,
    author_lists,
    bad_list_literal,
    clean_labels,
    distinct_sorted,
    empty_list,
    list_to_text,
    lower_all,
    or_empty,
    parse_list_literal,
    path_level,
    reference_list,
    subset_of,
    term_names,
    venue_lists,
)
from .text import invert_text, max_position, rebuild_text
