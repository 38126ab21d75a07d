"""Date parsing, grain conversion and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.functions.frequency import Frequency, parse_frequency, parse_mixed_date, truncate
from mediamix.grain import Grain, join_on


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed, lowercased column names; two names that fold into one are an error."""
    names = [c.strip().lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after lowercasing: {twice}")
    return df.toDF(*names)


def parse_dates(df: DataFrame, date: str) -> DataFrame:
    """Text dates become dates; a date column is left as it is."""
    kind = dict(df.dtypes)[date]
    if kind == "date":
        return df
    return df.withColumn(date, parse_mixed_date(F.col(date)) if kind == "string" else F.col(date).cast("date"))


def convert_grain(
    df: DataFrame,
    date: str,
    start: str | Frequency,
    end: str | Frequency,
    week_label: str = "iso_minus_1",
) -> DataFrame:
    """Move dates to the first day of the coarser period; finer is not possible."""
    source, target = parse_frequency(start), parse_frequency(end)
    if target.rank < source.rank:
        raise ValueError(f"cannot go from {source.name.lower()} to the finer {target.name.lower()}")
    if source is target:
        return df
    parsed = parse_dates(df, date)
    return parsed.withColumn(date, truncate(F.col(date), target, week_label))


def _on_grid(grain: Grain, frequency: Frequency):
    date, first = F.col(grain.date), F.col("__first")
    if frequency is Frequency.DAY:
        return F.lit(True)
    if frequency is Frequency.WEEK:
        return F.datediff(date, first) % 7 == 0
    months = (F.year(date) - F.year(first)) * 12 + F.month(date) - F.month(first)
    step = 1 if frequency is Frequency.MONTH else 3
    return (months % step == 0) & (F.add_months(first, months) == date)


def date_spine(df: DataFrame, grain: Grain, frequency: str | Frequency) -> DataFrame:
    """Every period from each segment's first to its last date."""
    step = parse_frequency(frequency).step
    return (
        df.filter(F.col(grain.date).isNotNull())
        .groupBy(*grain.keys)
        .agg(F.min(grain.date).alias("__first"), F.max(grain.date).alias("__last"))
        .select(*grain.keys, F.explode(F.sequence("__first", "__last", step)).alias(grain.date))
    )


def date_gaps(df: DataFrame, grain: Grain, frequency: str | Frequency) -> DataFrame:
    """Periods of the spine that no row covers.

    Only distinct (keys, date) pairs are shuffled, at most one per calendar day and
    segment.
    """
    dates = df.select(*grain.columns).filter(F.col(grain.date).isNotNull()).distinct()
    return _filled(dates, grain, parse_frequency(frequency)).filter(F.col("__place") > 0).drop("__place")


def _filled(dated: DataFrame, grain: Grain, frequency: Frequency) -> DataFrame:
    """Rows unique on (keys, date) followed by the periods missing after them.

    Each row looks at the next date of its segment and unfolds into itself, with
    ``__place`` 0, and one row per period in between.  Rows off the step grid drop out.
    """
    date, first = F.col(grain.date), F.col("__first")
    if frequency is not Frequency.DAY:
        dated = dated.withColumn("__first", F.min(grain.date).over(grain.whole())).filter(_on_grid(grain, frequency))
    following = F.lead(grain.date).over(grain.positions())
    if frequency in (Frequency.DAY, Frequency.WEEK):
        step = 1 if frequency is Frequency.DAY else 7
        distance = F.datediff("__following", date) / step
        moved = F.date_add(date, F.col("__place") * step)
    else:
        step = 1 if frequency is Frequency.MONTH else 3

        def months(later, earlier):
            return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)

        distance = months(F.col("__following"), date) / step
        moved = F.add_months(first, months(date, first) + F.col("__place") * step)
    places = F.sequence(F.lit(0), F.greatest(F.coalesce(distance.cast("int") - 1, F.lit(0)), F.lit(0)))
    values = [c for c in dated.columns if c not in (*grain.columns, "__first")]
    return (
        dated.withColumn("__following", following)
        .withColumn("__place", F.explode(places))
        .select(
            *grain.keys,
            moved.alias(grain.date),
            *[F.when(F.col("__place") == 0, F.col(c)).alias(c) for c in values],
            "__place",
        )
    )


def fill_calendar(df: DataFrame, grain: Grain, frequency: str | Frequency) -> DataFrame:
    """Continuous calendar per segment: gaps become rows with null values.

    Rows off the segment's step grid and rows without a date drop out, duplicates stay.
    With a unique grain this is one pass: a window and an explode, partitioned like the
    fills that follow.  Otherwise the rows stay where they are (all are on the daily
    grid, and on a coarser one a join with the segment's first date tells) and the gaps,
    found on the distinct dates, are added by union, so a segment or day with very many
    rows is never shuffled as a group.
    """
    frequency = parse_frequency(frequency)
    facts = df.filter(F.col(grain.date).isNotNull())
    if grain.unique:
        return _filled(facts, grain, frequency).select(*df.columns)
    if frequency is not Frequency.DAY:
        first = facts.groupBy(*grain.keys).agg(F.min(grain.date).alias("__first"))
        facts = join_on(facts, first, grain.keys).filter(_on_grid(grain, frequency)).drop("__first")
    return facts.unionByName(date_gaps(df, grain, frequency), allowMissingColumns=True)


def off_grid_report(df: DataFrame, grain: Grain, frequency: str | Frequency) -> DataFrame:
    """(keys, n_rows, n_off_grid, n_without_date): what the calendar step leaves out."""
    frequency = parse_frequency(frequency)
    first = df.groupBy(*grain.keys).agg(F.min(grain.date).alias("__first"))
    dated = F.col(grain.date).isNotNull()
    return (
        join_on(df.select(*grain.columns), first, grain.keys)
        .groupBy(*grain.keys)
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(dated & ~_on_grid(grain, frequency)).alias("n_off_grid"),
            F.count_if(~dated).alias("n_without_date"),
        )
    )
