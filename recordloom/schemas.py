"""Explicit schemas of the records, the works snapshot and the label map."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_TEXTS = T.ArrayType(T.StringType())


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])



def record_schema(key: str = "record_id") -> T.StructType:
    """The target record under the key name a master table uses."""
    # Names, order and types.
    return _fields(
        ("paper", _TEXT),
        ("mesh_terms", _TEXTS),
        ("venue_ids", _TEXTS),
        ("venue_names", _TEXTS),
        ("author_ids", _TEXTS),
        ("author_names", _TEXTS),
        ("reference_ids", _TEXTS),
        ("title", _TEXT),
        ("abstract", _TEXT),
        ("isOpenAccess", T.BooleanType()),
        ("fullDocLink", _TEXT),
        (key, T.LongType()),
        ("doi", _TEXT),
        ("level1", _TEXTS),
        ("level2", _TEXTS),
        ("level3", _TEXTS),
        ("isBiomimicry", _TEXT),
        ("url", _TEXT),
        ("mag_terms", _TEXTS),
        ("species", _TEXTS),
        ("absolute_relevancy", T.ArrayType(T.DoubleType())),
        ("relative_relevancy", T.ArrayType(T.DoubleType())),
    )


RECORD_SCHEMA = record_schema()

# The fields of a bibliographic work that enrichment reads.
_VENUE = _fields(("id", _TEXT), ("display_name", _TEXT))
WORK_SCHEMA = _fields(
    ("id", _TEXT),
    ("doi", _TEXT),
    ("title", _TEXT),
    ("mesh", T.ArrayType(_fields(("descriptor_name", _TEXT)))),
    ("host_venue", _VENUE),
    ("alternate_host_venues", T.ArrayType(_VENUE)),
    ("authorships", T.ArrayType(_fields(("author", _VENUE)))),
    ("referenced_works", _TEXTS),
    ("abstract_inverted_index", T.MapType(_TEXT, T.ArrayType(T.IntegerType()))),
    ("open_access", _fields(("is_oa", T.BooleanType()), ("oa_url", _TEXT))),
)

# Columns of a label map file, target taxonomy first.
LABEL_MAP_SCHEMA = _fields(
    ("Level I", _TEXT),
    ("Level II", _TEXT),
    ("Level III", _TEXT),
    ("Alevel I", _TEXT),
    ("Alevel II", _TEXT),
    ("Alevel III", _TEXT),
)

# One collected paper before enrichment; lists are text in CSV.
PAPER_SCHEMA = _fields(
    ("record_id", T.LongType()),
    ("doi", _TEXT),
    ("url", _TEXT),
    ("label_level_1", _TEXTS),
    ("label_level_2", _TEXTS),
    ("label_level_3", _TEXTS),
    ("title", _TEXT),
    ("abstract", _TEXT),
    ("venue_names", _TEXT),
    ("full_doc_link", _TEXT),
    ("is_open_access", _TEXT),
    ("isBiomimicry", _TEXT),
)

POST_SCHEMA = _fields(
    ("post_type_label", _TEXT),
    ("post_modified", T.TimestampType()),
    ("taxonomies_hierarchical", _fields(
        ("function", _fields(("lvl0", _TEXTS), ("lvl1", _TEXTS), ("lvl2", _TEXTS))))),
    ("reference_sources", _fields(("source_link", _TEXTS))),
    ("sources", _fields(("source_link", _TEXTS))),
)

PAGE_SCHEMA = _fields(("url", _TEXT), ("html", _TEXT))
