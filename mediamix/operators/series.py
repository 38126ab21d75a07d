"""Ordered operators along a segment's dates: fills, interpolation, trailing means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.grain import Grain, join_on

POSITION = "__position"


def _forward(value: Column, grain: Grain) -> Column:
    return F.last(value, ignorenulls=True).over(grain.forward())


def _nearest_known(value: Column, grain: Grain) -> Column:
    """Last known value, for the rows before the first known one the next one."""
    return F.coalesce(_forward(value, grain), F.last(value, ignorenulls=True).over(grain.backward()))


def _between(value: Column, grain: Grain) -> Column:
    """Straight line by row position between the known values on either side."""
    place = F.when(value.isNotNull(), F.col(POSITION))
    before, after = _forward(value, grain), F.last(value, ignorenulls=True).over(grain.backward())
    start, stop = _forward(place, grain), F.last(place, ignorenulls=True).over(grain.backward())
    return F.when(value.isNotNull(), value).when(
        before.isNotNull() & after.isNotNull(),
        before + (after - before) * (F.col(POSITION) - start) / (stop - start),
    )


def _between_or_held(value: Column, grain: Grain) -> Column:
    """As ``interpolate``, with the edges held at the nearest known value."""
    return F.coalesce(_between(value, grain), _nearest_known(value, grain))


FILLS = {
    "forward_fill": _forward,
    "nearest_known": _nearest_known,
    "interpolate": _between,
    "interpolate_hold": _between_or_held,
}


def fill_series(df: DataFrame, grain: Grain, fills: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Set each column ``name`` to ``value`` with its nulls filled along the dates.

    ``fills`` maps name to (value, method).  All fills share the partitioning and one
    sort per direction.  Without a unique grain the rows are first reduced to one per
    (keys, date), of which a segment has no more than the calendar has days; rows of one
    date then share a fill, and the largest known value of a date stands for it.
    """
    if not fills:
        return df
    unknown = {method for _, method in fills.values()} - set(FILLS)
    if unknown:
        raise ValueError(f"unknown fill methods {sorted(unknown)}")
    work = df.withColumns({f"__value_{c}": value for c, (value, _) in fills.items()})
    series = work
    if not grain.unique:
        series = work.groupBy(*grain.columns).agg(
            *[F.max(f"__value_{c}").alias(f"__value_{c}") for c in fills]
        )
    if any(method.startswith("interpolate") for _, method in fills.values()):
        series = series.withColumn(POSITION, F.row_number().over(grain.positions()))
    filled = {f"__filled_{c}": FILLS[method](F.col(f"__value_{c}"), grain) for c, (_, method) in fills.items()}
    series = series.withColumns(filled)
    if not grain.unique:
        work = join_on(work, series.select(*grain.columns, *filled), grain.columns, "left")
    else:
        work = series
    done = work.withColumns({c: F.coalesce(f"__value_{c}", f"__filled_{c}") for c in fills})
    return done.drop(*[f"__value_{c}" for c in fills], *filled, POSITION)


def trailing_mean(df: DataFrame, grain: Grain, columns: Mapping[str, Column], window: int = 3) -> DataFrame:
    """Set each column to the mean of the current and the ``window - 1`` previous rows.

    Without a unique grain the frame counts dates instead of rows: the mean of all
    values on the last ``window`` dates.
    """
    if not columns:
        return df
    if grain.unique:
        frame = grain.trailing(window)
        return df.withColumns({c: F.avg(value).over(frame) for c, value in columns.items()})
    work = df.withColumns({f"__value_{c}": value for c, value in columns.items()})
    frame = grain.trailing(window)
    days = work.groupBy(*grain.columns).agg(
        *[F.sum(f"__value_{c}").alias(f"__sum_{c}") for c in columns],
        *[F.count(f"__value_{c}").alias(f"__n_{c}") for c in columns],
    )
    means = days.select(
        *grain.columns,
        *[
            F.try_divide(F.sum(f"__sum_{c}").over(frame), F.sum(f"__n_{c}").over(frame)).alias(f"__mean_{c}")
            for c in columns
        ],
    )
    done = join_on(work, means, grain.columns, "left").withColumns({c: F.col(f"__mean_{c}") for c in columns})
    return done.drop(*[f"__value_{c}" for c in columns], *[f"__mean_{c}" for c in columns])
