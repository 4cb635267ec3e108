"""Lists inside a row: parsing, cleaning, merging and pulling fields out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .identifiers import _col, bad_work_id, extract_work_id, is_blank, let

PATH_SEPARATOR = " > "
_LIST_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true"}


def empty_list(element: str = "string") -> Column:
    return F.array().cast(f"array<{element}>")


def or_empty(c: Column | str, element: str = "string") -> Column:
    """A list, or the empty list for null."""
    return F.coalesce(_col(c), empty_list(element))


def path_level(c: Column | str, level: int) -> Column:
    """The ``level``-th part of each path text that has one; ``[]`` for a missing list."""
    parts = F.transform(or_empty(c), lambda x: F.get(F.split(x, PATH_SEPARATOR), F.lit(level)))
    return F.filter(parts, lambda x: x.isNotNull())


def _parsed(c: Column, element: str) -> Column:
    """The list, or null. A text that is a list only with ``None`` for a missing element is read, too."""
    kind = f"array<{element}>"
    named = F.regexp_replace(c, r"(?<=[\[,\s])None(?=[\s,\]])", "null")
    return F.coalesce(F.from_json(c, kind, _LIST_OPTIONS), F.from_json(named, kind, _LIST_OPTIONS))


def parse_list_literal(c: Column | str, element: str = "string") -> Column:
    """A list written as text, with either kind of quotes; ``[]`` if missing."""
    return F.coalesce(_parsed(_col(c), element), empty_list(element))


def bad_list_literal(c: Column | str, element: str = "string") -> Column:
    """True for a non-blank text that is not a list."""
    c = _col(c)
    return ~is_blank(F.trim(c)) & _parsed(c, element).isNull()


def lossy_list_literal(c: Column | str, element: str = "string") -> Column:
    """True for a non-blank text that is not a list, or has an element that is not of the type."""
    c = _col(c)
    texts, values = _parsed(c, "string"), _parsed(c, element)
    dropped = F.exists(F.arrays_zip(texts.alias("t"), values.alias("v")), lambda x: x["t"].isNotNull() & x["v"].isNull())
    return bad_list_literal(c, element) | F.coalesce(dropped, F.lit(False))


def lower_all(c: Column | str) -> Column:
    return F.transform(_col(c), F.lower)


def clean_labels(c: Column | str) -> Column:
    """Each whitespace character to ``_``, then lower case; ``[]`` for null."""
    return F.transform(or_empty(c), lambda x: F.lower(F.regexp_replace(x, r"(?U)\s", "_")))


def distinct_sorted(c: Column | str) -> Column:
    return F.sort_array(F.array_distinct(_col(c)))


def append_missing(base: Column | str, extra: Column | str) -> Column:
    """``base`` and then what only ``extra`` has, order and repeats kept."""

    def appended(b: Column) -> Column:
        new = F.filter(
            or_empty(extra), lambda x: ~F.coalesce(F.array_contains(b, x), F.lit(False))
        )
        return F.concat(b, new)

    return let(or_empty(base), appended)


def subset_of(c: Column | str, allowed: list) -> Column:
    """True when every element is in the set; the empty list passes."""
    members = F.array(*[F.lit(v) for v in allowed]) if allowed else empty_list()
    return F.size(F.array_except(_col(c), members)) == 0


def term_names(mesh: Column | str) -> Column:
    """Names of an array of subject terms."""
    return F.coalesce(F.transform(_col(mesh), lambda m: m["descriptor_name"]), empty_list())


def venue_lists(host: Column | str, alternates: Column | str) -> tuple[Column, Column]:
    """Venue ids and names: alternates that have one, the host last.

    Without a host both are empty. The host id is shortened, the others are not.
    """
    host, alternates = _col(host), _col(alternates)

    def listed(field: str, last: Column) -> Column:
        others = F.filter(
            F.transform(alternates, lambda v: v[field]), lambda x: ~is_blank(x)
        )
        both = F.concat(F.coalesce(others, empty_list()), F.array(last))
        return F.when(host.isNotNull(), both).otherwise(empty_list())

    return (
        listed("id", extract_work_id(host["id"])),
        listed("display_name", host["display_name"]),
    )


def author_lists(authorships: Column | str) -> tuple[Column, Column]:
    """Author ids (shortened) and names, in order."""
    authors = F.transform(_col(authorships), lambda a: a["author"])
    return (
        F.coalesce(F.transform(authors, lambda a: extract_work_id(a["id"])), empty_list()),
        F.coalesce(F.transform(authors, lambda a: a["display_name"]), empty_list()),
    )


def reference_list(works: Column | str) -> Column:
    """Shortened ids of the works a record cites."""
    return F.coalesce(F.transform(_col(works), extract_work_id), empty_list())


def any_bad_work_id(ids: Column | str) -> Column:
    """True when a list holds a text that is not a work id url."""
    return F.coalesce(F.exists(_col(ids), bad_work_id), F.lit(False))


def access_fields(access: Column | str) -> tuple[Column, Column]:
    """Access flag and document link of the nested access object."""
    access = _col(access)
    return access["is_oa"].cast("boolean"), access["oa_url"]


def list_to_text(c: Column | str) -> Column:
    """A list as text, for formats without lists."""
    return F.to_json(_col(c))
