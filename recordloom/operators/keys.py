"""First or last row per key, and new contiguous keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import scratch_path

_KEY, _SALT = "_key", "_salt"
_RIGHT_KEY, _RIGHT_SALT = "_right_key", "_right_salt"
_RANK = "_rank"
_AT = "_at"
_PART = "_part"
_OFFSET = "_offset"


# Rows without a key are dealt out by a hash of so many columns.
_SPREAD = 4


def _spread(df: DataFrame) -> Column:
    """A number that differs between most rows: a hash of a few plain columns, numbers and times before texts."""
    plain = [f for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    chosen = sorted(plain, key=lambda f: isinstance(f.dataType, (T.StringType, T.BinaryType, T.BooleanType)))[:_SPREAD]
    return F.hash(*[F.col(f"`{f.name}`") for f in chosen]) if chosen else F.lit(0)


def lookup_join(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "left"
) -> DataFrame:
    """Equi-join for skewed keys; the sides must not share column names.

    Rows of the left side without a key can match nothing. They are joined
    under a hash of a few of their other columns, so they are spread, and what
    the caller filters by still reaches the scan of the left side. The salt of
    all other rows is 0. As it is part of the join key, both sides are
    exchanged for this very join, which lets adaptive execution split the
    partition of a key, or of a salt, that holds very many rows. A right side
    that is known to be small is broadcast as usual.
    """
    none = F.pmod(F.hash(left_key), F.lit(1))
    salt = F.when(left_key.isNull(), _spread(left)).otherwise(none)
    keyed = left.withColumns({_KEY: left_key, _SALT: salt})
    table = right.withColumns(
        {_RIGHT_KEY: right_key, _RIGHT_SALT: F.pmod(F.hash(right_key), F.lit(1))}
    )
    same = (F.col(_KEY) == F.col(_RIGHT_KEY)) & (F.col(_SALT) == F.col(_RIGHT_SALT))
    return keyed.join(table, same, how).drop(_KEY, _SALT, _RIGHT_KEY, _RIGHT_SALT)


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # Filtering row_number() = 1 lets Spark cut every group to one row per task
    # before the shuffle, so a key that holds a third of the rows sends no more
    # than a rare one.
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(by)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key. ``order`` must be total for a fixed result."""
    return _ranked(df, keys, [F.asc_nulls_last(c) for c in order])


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key. ``order`` must be total for a fixed result."""
    return _ranked(df, keys, [F.desc_nulls_first(c) for c in order])


def order_value(order: list[str]) -> Column:
    """What to compare rows by: the column itself, a struct of several."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _pinned_order(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows sorted into partitions, with partition number and position.

    Written to a table in the shared folder, so that all later passes see the
    same partitions even when an executor is lost, and a pass that needs few
    columns reads no others.
    """
    path = scratch_path(df.sparkSession, "ordered")
    by = [F.asc_nulls_last(c) for c in order]
    df.orderBy(*by).withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    # The generated id is the partition number above 33 bits of position.
    return df.sparkSession.read.parquet(path).withColumn(_PART, F.shiftright(_AT, 33))


def _earlier_parts():
    """Window over all partitions before this one, of a frame with one row each."""
    return Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)


def assign_sequential_ids(
    df: DataFrame, id_col: str, start: int, order: list[str]
) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the given total order.

    The rows are range-partitioned, sorted once and written; then the sizes of
    the partitions give each its offset. Only one count per partition is ever
    looked at in one place.
    """
    placed = _pinned_order(df.drop(id_col), order)
    before = F.coalesce(F.sum("count").over(_earlier_parts()), F.lit(0))
    offsets = placed.groupBy(_PART).count().select(_PART, before.alias(_OFFSET))
    local = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), _PART)  # one row per partition
        .withColumn(id_col, F.lit(start).cast("bigint") + F.col(_OFFSET) + local)
        .drop(_AT, _PART, _OFFSET)
    )


def fill_down(df: DataFrame, events: dict[str, Column], order: list[str]) -> DataFrame:
    """Set each column to the last non-null value of its event up to the row.

    Each sorted partition is filled by itself and starts with what the
    partitions before it end with.
    """
    noted = df.withColumns({f"_event_{name}": event for name, event in events.items()})
    placed = _pinned_order(noted, order)
    within = Window.partitionBy(_PART).orderBy(_AT)
    ends = placed.groupBy(_PART).agg(
        *[
            F.max_by(f"_event_{n}", F.when(F.col(f"_event_{n}").isNotNull(), F.col(_AT))).alias(n)
            for n in events
        ]
    )
    carried = ends.select(
        _PART, *[F.last(n, True).over(_earlier_parts()).alias(f"_carried_{n}") for n in events]
    )
    filled = {
        n: F.coalesce(F.last(f"_event_{n}", True).over(within), F.col(f"_carried_{n}"))
        for n in events
    }
    return (
        placed.join(F.broadcast(carried), _PART)  # one row per partition
        .withColumns(filled)
        .select(*df.columns, *[n for n in events if n not in df.columns])
    )


def next_key(df: DataFrame, key: str) -> int:
    """One above the largest key; 1 for a table without keys."""
    highest = df.agg(F.max(key)).first()[0]
    return 1 if highest is None else int(highest) + 1
