"""Segment keys, date column and the joins and windows built on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grain:
    """What one row of a panel stands for.

    ``unique`` states that a panel holds at most one row per (keys, date), as every
    frame grouped on them does.  A segment then has no more rows than the calendar has
    days, so one window task per segment is safe however large the input was.  Without
    it, operators first reduce the rows to one per (keys, date) with map-side
    aggregation and join the result back, so a segment holding a large part of all
    rows never has to fit in one task.
    """

    keys: tuple[str, ...]
    date: str = "date"
    unique: bool = False

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.date]

    def as_unique(self) -> Grain:
        return replace(self, unique=True)

    def forward(self) -> WindowSpec:
        """First row of the segment up to the current one."""
        return (
            Window.partitionBy(*self.keys)
            .orderBy(self.date)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def backward(self) -> WindowSpec:
        """Last row of the segment back to the current one.

        Descending order with a growing frame: an ascending order with a shrinking
        frame is re-evaluated from scratch on every row.
        """
        return (
            Window.partitionBy(*self.keys)
            .orderBy(F.col(self.date).desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def whole(self) -> WindowSpec:
        """All rows of the segment, ordered like the other windows so that they share a sort."""
        return (
            Window.partitionBy(*self.keys)
            .orderBy(self.date)
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )

    def trailing(self, rows: int) -> WindowSpec:
        return (
            Window.partitionBy(*self.keys).orderBy(self.date).rowsBetween(-(rows - 1), Window.currentRow)
        )

    def positions(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.date)


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the keys of ``left``.

    No broadcast hint: the side statistics seen by AQE decide, so a segment summary
    that outgrows the threshold falls back to a shuffled join with skew splitting.
    """
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__right_{k}"]) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__right_{k}" for k in keys])


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of each key in one task and in order, so that sums of doubles over them are the same in every run.

    Sums of the same doubles in another order differ in the last bit, and what is equal then
    no longer ties. For keys of few rows, such as the channels or the periods of a solution.
    """
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


# Largest table to send to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def join_measured(
    left: DataFrame, right: DataFrame, keys: Sequence[str], row_bytes: int, how: str = "inner"
) -> DataFrame:
    """``join_on`` for a large ``left`` and a ``right`` that is already written out.

    The rows of ``right`` are counted: if they are few it is broadcast, so that ``left``
    is not shuffled on keys one of which may hold a large part of it; if not, the join
    is a shuffled one.
    """
    small = right.count() * row_bytes <= BROADCAST_BYTES
    return join_on(left, F.broadcast(right) if small else right, keys, how)


def tidy(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn each row of a (usually one-row) wide aggregate into one row per metric."""
    return df.select(
        F.inline(F.array(*[F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]))
    )
