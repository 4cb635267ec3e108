"""Projections that bring collected rows into shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.lists import empty_list, path_level

# Taxonomy levels of a post, by field name.
LEVEL_FIELDS = ("lvl0", "lvl1", "lvl2")


def month_start(ts: Column | str) -> Column:
    """First instant of the month of a timestamp."""
    return F.date_trunc("month", ts)


def incremental_since_month_start(
    df: DataFrame,
    ts_col: str,
    as_of: dt.datetime,
    type_col: str | None = None,
    type_value: str | None = None,
) -> DataFrame:
    """Rows changed after the start of the month of ``as_of``, of one type.

    Both bounds are literals of the column's own type, so a columnar source
    gets them as pushed filters.
    """
    start = dt.datetime(as_of.year, as_of.month, 1, tzinfo=as_of.tzinfo)
    cutoff = F.lit(start.isoformat(sep=" ")).cast(df.schema[ts_col].dataType)
    changed = df.filter(F.col(ts_col) > cutoff)
    if type_col is not None:
        changed = changed.filter(F.col(type_col) == F.lit(type_value))
    return changed


def first_present(*choices: tuple[Column, Column]) -> Column:
    """Value of the first ``(object, value)`` pair whose object is there."""
    picked = F.lit(None)
    for present, value in reversed(choices):
        picked = F.when(present.isNotNull(), value).otherwise(picked)
    return picked


def source_links(
    posts: DataFrame, objects: tuple[str, ...] = ("reference_sources", "sources")
) -> Column:
    """Links of the first source object a post has, even when its list is empty.

    An object without any field counts as none.
    """
    known = [name for name in objects if name in posts.columns]
    return first_present(
        *[(F.when(F.to_json(n) != "{}", F.col(n)), F.col(n)["source_link"]) for n in known]
    )


def explode_references(
    posts: DataFrame,
    links: Column | None = None,
    keep: list[str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per record and source link; records without links vanish."""
    links = source_links(posts) if links is None else links
    kept = [F.col(c) for c in (posts.columns if keep is None else keep)]
    out = posts.select(*kept, F.posexplode(links).alias("_pos", "url"))
    return out.drop("_pos") if position is None else out.withColumnRenamed("_pos", position)


def with_post_labels(posts: DataFrame, function: str = "taxonomies_hierarchical.function") -> DataFrame:
    """The three label lists of a post, from its path labels."""
    levels = {
        f"label_level_{k + 1}": path_level(f"{function}.{field}", k)
        for k, field in enumerate(LEVEL_FIELDS)
    }
    return posts.withColumns(levels)


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_missing(df: DataFrame, column: str = "url") -> DataFrame:
    return df.na.drop(subset=[column])


def fill_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing texts to ``""`` and missing lists to the empty list."""
    chosen = df.columns if columns is None else columns
    filled = {}
    for name in chosen:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            filled[name] = F.coalesce(F.col(name), F.lit(""))
        elif isinstance(kind, T.ArrayType):
            filled[name] = F.coalesce(F.col(name), empty_list(kind.elementType.simpleString()))
    return df.withColumns(filled) if filled else df


def col_or_default(df: DataFrame, name: str, default: object = None) -> Column:
    """A column if the frame has it, otherwise a default."""
    if name in df.columns:
        return F.col(name)
    return default if isinstance(default, Column) else F.lit(default)


def conform(df: DataFrame, schema: T.StructType | list[str]) -> DataFrame:
    """The given columns in the given order; a schema also fixes the types."""
    if isinstance(schema, T.StructType):
        return df.select(
            [col_or_default(df, f.name).cast(f.dataType).alias(f.name) for f in schema]
        )
    return df.select(*schema)


def sort_records(df: DataFrame, key: str, *ties: str, limit: int | None = None) -> DataFrame:
    """Ascending by key, rows without one last; ``limit`` takes a batch of it."""
    out = df.orderBy(F.asc_nulls_last(key), *[F.asc_nulls_last(c) for c in ties])
    return out if limit is None else out.limit(limit)
