"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a set and an unset flag.
YES = ["yes", "y", "true", "1"]
NO = ["no", "n", "false", "0"]

EPSILON = 1e-10


def flag_text(column: Column) -> Column:
    return F.trim(F.lower(column.cast("string")))


def flag_value(column: Column) -> Column:
    """1 for a yes, 0 for anything else, null included."""
    return F.when(flag_text(column).isin(YES), 1).otherwise(0).cast("int")


def flag_is_bad(column: Column) -> Column:
    """True where a non-null value is neither a yes nor a no."""
    return F.coalesce(~flag_text(column).isin(YES + NO), F.lit(False))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is 0 or null."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def clip(value: Column, low: Column, high: Column) -> Column:
    """Value held within [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def contains_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))
