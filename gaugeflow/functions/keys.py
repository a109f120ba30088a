"""Derived keys and the partition numbers computed from keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.plans.ranges import RangePartition

DEFAULT_BUCKETS = 8


def name_uuid(*parts: Column) -> Column:
    """Name-based UUID (version 3, MD5) of the joined text; NULL if a part is NULL."""
    digest = F.md5(F.concat(*[part.cast("string") for part in parts]).cast("binary"))

    def piece(start: int, length: int) -> Column:
        return F.substr(digest, F.lit(start), F.lit(length))

    # The variant digit is 8 | (digit & 3).
    variant = F.translate(piece(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-3"), piece(14, 3), F.lit("-"),
        variant, piece(18, 3), F.lit("-"), piece(21, 12),
    )


def hash_bucket(keys: Sequence[Column], buckets: int = DEFAULT_BUCKETS) -> Column:
    """Bucket number of a key, aligned with Spark's own hash partitioning.

    After an exchange on the same keys into a multiple of ``buckets`` partitions
    each task holds rows of one bucket only, so a keyed write needs no second
    shuffle to keep the number of files low.
    """
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def portable_bucket(keys: Sequence[Column], buckets: int = DEFAULT_BUCKETS) -> Column:
    """Bucket number from MD5, for files that other engines must prune too."""
    text = F.concat_ws("\u001f", *[key.cast("string") for key in keys])
    head = F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(8)), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(buckets)).cast("int")


def range_id(
    columns: Sequence[Column], types: Sequence[str], partitions: Sequence[RangePartition]
) -> Column:
    """Id of the range partition that holds a row, NULL when none does.

    The sorted ranges form a balanced tree of comparisons: log2(n) per row.
    """

    def literals(values):
        return [F.lit(v).cast(t) for v, t in zip(values, types)]

    def compare(values, or_equal: bool, greater: bool) -> Column:
        # Lexicographic comparison of the columns with the bound, last column first.
        result = None
        if not values:
            return F.lit(True)
        for column, bound in reversed(list(zip(columns, literals(values)))):
            strict = column > bound if greater else column < bound
            if result is None:
                result = (strict | (column == bound)) if or_equal else strict
            else:
                result = strict | ((column == bound) & result)
        return result

    def contains(p: RangePartition) -> Column:
        return compare(p.lower, p.lower_inclusive, True) & compare(
            p.upper, p.upper_inclusive, False
        )

    def tree(part: Sequence[RangePartition]) -> Column:
        if len(part) == 1:
            return F.when(contains(part[0]), F.lit(part[0].range_id))
        middle = len(part) // 2
        first_right = part[middle]
        below = compare(first_right.lower, not first_right.lower_inclusive, False)
        return F.when(below, tree(part[:middle])).otherwise(tree(part[middle:]))

    if not partitions:
        return F.lit(None).cast("int")
    return tree(sorted(partitions, key=RangePartition.sort_key)).cast("int")
