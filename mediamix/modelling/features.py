"""Time features and the long media panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamix.functions.frequency import Frequency, parse_frequency, truncate

TIME_FEATURES = ["trend", "season_sin", "season_cos", "holiday"]
DAYS_PER_YEAR = 365.25


def holidays_per_period(holidays: DataFrame, frequency: str | Frequency, week_label: str = "iso_minus_1") -> DataFrame:
    """(date, holiday): number of holidays in each period of the panel."""
    period = truncate(F.col("date"), parse_frequency(frequency), week_label)
    return holidays.select(period.alias("date")).groupBy("date").agg(F.count("*").cast("double").alias("holiday"))


def time_features(
    df: DataFrame,
    holidays: DataFrame,
    keys: Sequence[str] = ("segment",),
    frequency: str | Frequency = Frequency.WEEK,
    week_label: str = "iso_minus_1",
) -> DataFrame:
    """Add trend (weeks since the segment's start), yearly season and holiday count.

    ``holidays`` has one row per holiday with a ``date``; ``frequency`` and ``week_label``
    are those of the panel's dates.  The panel is read once: a segment has no more rows than
    the calendar has periods.
    """
    start = F.min("date").over(Window.partitionBy(*keys))
    angle = 2 * F.pi() * F.dayofyear("date") / DAYS_PER_YEAR
    return (
        df.withColumn("__start", start)
        .join(holidays_per_period(holidays, frequency, week_label), "date", "left")
        .withColumns(
            {
                "trend": F.datediff("date", "__start") / 7,
                "season_sin": F.sin(angle),
                "season_cos": F.cos(angle),
                "holiday": F.coalesce(F.col("holiday"), F.lit(0.0)),
            }
        )
        .drop("__start")
    )


def media_long(df: DataFrame, media: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(segment, date, channel, spend, exposure) from (channel, spend, exposure) columns."""
    entries = F.array(
        *[
            F.struct(
                F.lit(channel).alias("channel"),
                F.col(spend).cast("double").alias("spend"),
                F.col(exposure).cast("double").alias("exposure"),
            )
            for channel, spend, exposure in media
        ]
    )
    return df.select("segment", "date", F.inline(entries))
