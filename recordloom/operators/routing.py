"""Splits of one frame: by review flag, and by row errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ERROR = "error_reason"
# What readers could not read of a row: structs of file, field, raw text and reason.
RESCUED = "_rescued"


def route_by_flag(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """``(auto, review)``: rows without and with the flag; the flag is dropped.

    Persist ``df`` first when both sides are written and it is costly.
    """
    raised = F.coalesce(F.col(flag), F.lit(False))
    return df.filter(~raised).drop(flag), df.filter(raised).drop(flag)


def with_error(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Name of the first check a row fails, null for a sound row.

    In rows from a reader that rescues, the first thing it could not read comes before all checks.
    """
    lost = F.get(RESCUED, F.lit(0)) if RESCUED in df.columns else None
    # ``concat_ws`` leaves out the field of a line that is lost whole.
    reasons = [] if lost is None else [F.when(lost.isNotNull(), F.concat_ws(" is ", lost["field"], lost["reason"]))]
    reasons += [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()]
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return df.withColumn(ERROR, reason)


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: a row that fails a check is set aside with the reason.

    Rows of a reader that rescues fail if they lost anything; rejects keep
    ``_rescued``, good rows have nothing in it and lose the column.
    """
    checked = with_error(df, checks)
    return (
        checked.filter(F.col(ERROR).isNull()).drop(ERROR, RESCUED),
        checked.filter(F.col(ERROR).isNotNull()),
    )
