"""Reject reasons: every input row is either accepted or kept with a reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"

# Reasons.
CORRUPT = "corrupt"
NULL_KEY = "null_key"
NULL_ORDER = "null_order"
NULL_REQUIRED = "null_required"
NO_RANGE = "no_range"
BAD_FIELD = "bad_field"


def any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition


def tag(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add the reason of the first rule that holds; keep a reason set before."""
    reasons = [F.when(condition, F.lit(reason)) for reason, condition in rules]
    if REASON in df.columns:
        reasons.insert(0, F.col(REASON))
    return df.withColumn(REASON, F.coalesce(*reasons, F.lit(None).cast("string")))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def scan_tagged(scan: DataFrame, corrupt: str, reason: str, text: str) -> DataFrame:
    """Turn the corrupt-record column of a file scan into a reason and the column ``text``.

    The generator keeps every column in the scan. With column pruning Spark would check
    only the columns that a query happens to use, and the reason would depend on that.
    """
    rows = scan.select(F.inline_outer(F.array(F.struct(*scan.columns))))
    return tag(rows, [(reason, F.col(corrupt).isNotNull())]).withColumnRenamed(corrupt, text)
