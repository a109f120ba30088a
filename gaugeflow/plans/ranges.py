"""Range partitions of a table: bounds, order, overlap check."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class RangePartition:
    """One range over the partition columns; each end is inclusive or exclusive.

    A bound may name the first columns only, and an empty one is open: rows are then
    compared by the columns that it names.

    The label is a note of the spec and has no effect.
    """

    range_id: int
    lower: tuple
    upper: tuple
    lower_inclusive: bool = True
    upper_inclusive: bool = False
    label: str | None = None

    def sort_key(self):
        return self.span()[0]

    def span(self) -> tuple[tuple, tuple]:
        """Ends that compare like the bounds do, whatever columns these name.

        Behind the values stands where the end lies among rows that share them: before
        all (-1) or after all (1). An open end is before or after everything.
        """
        before = not self.lower or self.lower_inclusive
        after = not self.upper or self.upper_inclusive
        return (*self.lower, _End(-1 if before else 1)), (*self.upper, _End(1 if after else -1))

    def same_bounds(self, other: RangePartition) -> bool:
        return (
            self.lower == other.lower
            and self.upper == other.upper
            and self.lower_inclusive == other.lower_inclusive
            and self.upper_inclusive == other.upper_inclusive
        )


@functools.total_ordering
@dataclass(frozen=True)
class _End:
    """Before (-1) or after (1) every value."""

    side: int

    def __lt__(self, other) -> bool:
        return self.side < (other.side if isinstance(other, _End) else 0)

    def __gt__(self, other) -> bool:
        return self.side > (other.side if isinstance(other, _End) else 0)


BEFORE, AFTER = _End(-1), _End(1)


def check_ranges(partitions: Sequence[RangePartition]) -> None:
    """Refuse empty and overlapping ranges."""
    for p in partitions:
        low, high = p.span()
        if low >= high:
            raise ValueError(f"empty range {p.lower} .. {p.upper}")
    ordered = sorted(partitions, key=RangePartition.sort_key)
    for left, right in zip(ordered, ordered[1:]):
        if left.span()[1] > right.span()[0]:
            raise ValueError(
                f"range {left.lower} .. {left.upper} overlaps {right.lower} .. {right.upper}"
            )
