"""Calendar frequencies, date parsing and grain truncation."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Frequency(Enum):
    DAY = "D"
    WEEK = "W-SUN"
    MONTH = "M"
    QUARTER = "Q"

    @property
    def rank(self) -> int:
        return list(Frequency).index(self)

    @property
    def step(self) -> Column:
        return F.expr(
            {
                Frequency.DAY: "INTERVAL 1 DAY",
                Frequency.WEEK: "INTERVAL 7 DAY",
                Frequency.MONTH: "INTERVAL 1 MONTH",
                Frequency.QUARTER: "INTERVAL 3 MONTH",
            }[self]
        )


# Accepted spellings of each frequency.
ALIASES = {
    Frequency.DAY: ["d", "day", "daily"],
    Frequency.WEEK: ["w-sun", "w", "week", "weekly"],
    Frequency.MONTH: ["m", "month", "monthly"],
    Frequency.QUARTER: ["q", "a", "quarter", "quartely", "quart", "quarterly"],
}


def parse_frequency(name: str | Frequency) -> Frequency:
    if isinstance(name, Frequency):
        return name
    if not isinstance(name, str):
        raise ValueError("frequency must be a string")
    wanted = name.strip().lower()
    for frequency, spellings in ALIASES.items():
        if wanted in spellings:
            return frequency
    raise ValueError(f"unknown frequency {name!r}; use daily, weekly, monthly or quarterly")


def parse_mixed_date(text: Column) -> Column:
    """Day-first date, else ISO date, else null."""
    return F.coalesce(F.try_to_date(text, "dd-MM-yyyy"), F.try_to_date(text, "yyyy-MM-dd"))


def truncate(date: Column, frequency: Frequency, week_label: str = "iso_minus_1") -> Column:
    """First day of the period ``date`` lies in.

    ``iso_minus_1`` labels a week by the day before its ISO Monday, so a Sunday carries
    the label of the Sunday before it; ``sunday_start`` lets a Sunday open its own week.
    """
    if frequency is Frequency.DAY:
        return date
    if frequency is Frequency.WEEK:
        if week_label == "iso_minus_1":
            return F.date_add(F.date_trunc("week", date).cast("date"), -1)
        if week_label == "sunday_start":
            return F.date_sub(date, F.dayofweek(date) - 1)
        raise ValueError(f"unknown week label {week_label!r}")
    unit = "month" if frequency is Frequency.MONTH else "quarter"
    return F.date_trunc(unit, date).cast("date")
