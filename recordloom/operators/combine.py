"""Union of frames with differing columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.lists import list_to_text


def _as_text(df: DataFrame, name: str) -> DataFrame:
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return df
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return df.withColumn(name, list_to_text(name) if nested else F.col(name).cast("string"))


def combine(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; absent columns are null.

    A column of different types becomes text, lists in the form that the list
    parser reads; different types of numbers, or of instants, get a common one.
    """
    if not frames:
        raise ValueError("combine needs at least one frame")
    kinds: dict[str, dict[str, T.DataType]] = {}
    for df in frames:
        for f in df.schema:
            if not isinstance(f.dataType, T.NullType):
                kinds.setdefault(f.name, {})[f.dataType.simpleString()] = f.dataType
    for name, seen in kinds.items():
        alike = any(
            all(isinstance(t, family) for t in seen.values())
            for family in (T.NumericType, (T.DateType, T.TimestampType))
        )
        if len(seen) > 1 and not alike:
            frames = [_as_text(df, name) if name in df.columns else df for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
