"""Merge of new rows into a master table by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .keys import assign_sequential_ids, last_per_key, lookup_join, next_key, order_value

_NEW = "_new"

# Largest size of updates, in bytes, that may be sent to every executor.
BROADCAST_BYTES = 64 << 20


def _is_small(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most this many rows, and ``BROADCAST_BYTES`` written out; reads no more than that."""
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    counted = df.limit(rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return counted[0] <= rows and counted[1] <= BROADCAST_BYTES


def _master_keys(master: DataFrame, key: str, master_order: list[str] | None) -> DataFrame:
    """Keys of the master, each with the place of its first row if order is given."""
    keyed = master.filter(F.col(key).isNotNull())
    if master_order is None:
        return keyed.select(key).distinct()
    return keyed.groupBy(key).agg(F.min(order_value(master_order)).alias("_first"))


def update_master(
    master: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    master_order: list[str] | None = None,
    keep_old_if_null: bool = False,
    broadcast_rows: int | None = None,
    write_order: bool = False,
) -> DataFrame:
    """The master with every matched row overwritten by the last update of its key.

    All columns of the update are written, nulls too unless
    ``keep_old_if_null``; columns only the update has are added. With
    ``master_order`` only the first master row of a repeated key changes;
    without it the key is taken to be unique in the master.

    Columns that only order the updates are not written unless ``write_order``.

    ``broadcast_rows``: count the updates first, and if there are no more than
    this many, of no more than ``BROADCAST_BYTES`` together, keep the master
    where it is and send the updates to it. Without it, or above it, both sides
    are exchanged; the result is the same.
    """
    values = [
        c for c in updates.columns if c != key and (c in master.columns or write_order or c not in order)
    ]
    keyed = updates.filter(F.col(key).isNotNull())
    winners = last_per_key(keyed, [key], order).select(
        F.col(key).alias("_k"), F.struct(F.lit(True).alias("_hit"), *values).alias(_NEW)
    )
    small = broadcast_rows is not None and _is_small(keyed, broadcast_rows)

    if master_order is not None:
        first = _master_keys(master, key, master_order)
        winners = winners.join(first, F.col("_k") == F.col(key)).drop(key)
        # The whole order is part of the join key, so rows with one hot key,
        # or without a key, are spread over all partitions.
        match = F.col(key) == F.col("_k")
        for name in master_order:
            place = F.col("_first") if len(master_order) == 1 else F.col("_first")[name]
            match = match & F.col(name).eqNullSafe(place)
        right = F.broadcast(winners) if small else winners
        joined = master.join(right, match, "left")
    elif small:
        joined = master.join(F.broadcast(winners), F.col(key) == F.col("_k"), "left")
    else:
        joined = lookup_join(master, winners, F.col(key), F.col("_k"))

    hit = F.col(_NEW).isNotNull()

    def merged(name: str):
        new = F.col(_NEW)[name]
        if name not in master.columns:
            return new.alias(name)
        old = F.col(name)
        taken = F.coalesce(new, old) if keep_old_if_null else new
        return F.when(hit, taken).otherwise(old).alias(name)

    kept = [F.col(c) if c not in values else merged(c) for c in master.columns]
    added = [merged(c) for c in values if c not in master.columns]
    return joined.select(*kept, *added)


def new_rows(master: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates whose key is not in the master, rows without a key included."""
    known = _master_keys(master, key, None).withColumnRenamed(key, "_known")
    return lookup_join(updates, known, F.col(key), F.col("_known"), "left_anti")


def upsert(
    master: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    master_order: list[str] | None = None,
    keep_old_if_null: bool = False,
    broadcast_rows: int | None = None,
    write_order: bool = False,
) -> DataFrame:
    """Updated master, then the unmatched updates under fresh keys.

    Of updates with the same key the last by ``order`` (a total order) wins.
    Unmatched updates are all inserted, numbered from the largest master key
    plus one in that order, whatever key they came with.
    Order columns that are not master columns are written with ``write_order``.
    """
    updated = update_master(
        master, updates, key, order, master_order, keep_old_if_null, broadcast_rows, write_order
    )
    inserts = assign_sequential_ids(
        new_rows(master, updates, key), key, next_key(master, key), order
    )
    written = [c for c in inserts.columns if c in updated.columns]
    return updated.unionByName(inserts.select(*written), allowMissingColumns=True)
