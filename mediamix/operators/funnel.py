"""Funnel ratios per channel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.functions.scalars import ratio_or_zero
from mediamix.grain import tidy
from mediamix.operators.rules import funnel_role, primary_exposures

# Role pairs that form a ratio, numerator over denominator.
RATIOS = [
    ("engagement", "exposure"),
    ("conversion", "engagement"),
    ("cost", "engagement"),
    ("cost", "exposure"),
    ("cost", "conversion"),
]


def clean_name(name: Column, channel: Column) -> Column:
    """Metric name without its channel as a prefix, suffix or inner part.

    The channel is looked for, as plain text, with underscores, with spaces, as written
    and run together, the longest spellings first.
    """
    spelled = F.lower(F.trim(channel))
    forms = [
        F.replace(spelled, F.lit(" "), F.lit("_")),
        F.replace(spelled, F.lit("_"), F.lit(" ")),
        spelled,
        F.replace(spelled, F.lit(" "), F.lit("")),
    ]

    def strip(text: Column, token: Column) -> Column:
        quoted = F.concat(F.lit("\\Q"), token, F.lit("\\E"))
        text = F.regexp_replace(text, F.concat(F.lit("^"), quoted, F.lit("_")), F.lit(""))
        text = F.regexp_replace(text, F.concat(F.lit("_"), quoted, F.lit("$")), F.lit(""))
        return F.regexp_replace(text, F.concat(F.lit("_"), quoted, F.lit("_")), F.lit("_"))

    bare = reduce(strip, forms, F.lower(name))
    return F.trim(F.regexp_replace(bare, "_+", "_"), F.lit("_"))


def channel_key(channel: Column) -> Column:
    return F.replace(F.lower(channel), F.lit(" "), F.lit("_"))


def funnel_roles(catalog: DataFrame) -> DataFrame:
    """(field_name, channel, funnel_role)."""
    return catalog.select("field_name", "channel", funnel_role().alias("funnel_role"))


def funnel_ratios(catalog: DataFrame) -> DataFrame:
    """Ratios the catalogue allows: channel, names of both sides, roles and the new name.

    One row per ratio column to create.  The exposure side is the channel's primary
    exposure only; where names collide the first in catalogue order stays.
    """
    sides = (
        catalog.filter((F.col("data_type") == "absolute") & F.col("channel").isNotNull())
        .select("pos", "field_name", "channel", funnel_role().alias("role"))
        .join(primary_exposures(catalog), "channel", "left")
        .filter((F.col("role") != "exposure") | (F.col("field_name") == F.col("primary_exposure")))
        .withColumn("clean", clean_name(F.col("field_name"), F.col("channel")))
    )
    allowed = F.array(*[F.struct(F.lit(n).alias("role"), F.lit(d).alias("den_role")) for n, d in RATIOS])
    numerators = sides.select(
        "channel",
        F.col("pos").alias("num_pos"),
        F.col("field_name").alias("numerator"),
        F.col("clean").alias("num_clean"),
        F.explode(F.transform(F.filter(allowed, lambda r: r["role"] == F.col("role")), lambda r: r["den_role"])).alias("den_role"),
        F.col("role").alias("num_role"),
    )
    denominators = sides.select(
        F.col("channel").alias("den_channel"),
        F.col("pos").alias("den_pos"),
        F.col("field_name").alias("denominator"),
        F.col("clean").alias("den_clean"),
        F.col("role").alias("of_role"),
    )
    named = numerators.join(
        denominators,
        (F.col("channel") == F.col("den_channel")) & (F.col("den_role") == F.col("of_role")),
    ).withColumn(
        "field_name",
        F.concat(channel_key(F.col("channel")), F.lit("__"), F.col("num_clean"), F.lit("_per_"), F.col("den_clean")),
    )
    first = F.struct("num_pos", "den_pos")
    return named.groupBy("field_name").agg(
        *[F.min_by(c, first).alias(c) for c in ("channel", "numerator", "denominator")],
        F.min_by(F.concat_ws("/", "num_role", "den_role"), first).alias("funnel_role"),
        F.min(first)["num_pos"].alias("num_pos"),
        F.min(first)["den_pos"].alias("den_pos"),
    )


def derived_metrics(ratios: DataFrame) -> DataFrame:
    """Catalogue rows of the ratios, to append with ``extend_catalog``.

    Their position, a decimal, puts them behind all original rows (whose positions are
    longs) in the order of numerator and denominator.
    """
    behind = F.lit("10000000000000000000").cast("decimal(20,0)")
    place = behind * (F.col("num_pos") + 1).cast("decimal(17,0)") + F.col("den_pos").cast("decimal(19,0)")
    return ratios.select(
        place.cast("decimal(38,0)").alias("pos"),
        "field_name",
        "channel",
        F.concat_ws("/", "numerator", "denominator").alias("derived_from"),
        "funnel_role",
    )


def plan_ratios(catalog: DataFrame, columns: list[str]) -> list[tuple[str, str, str]]:
    """(name, numerator, denominator) to add to a table with ``columns``."""
    present = catalog.filter(F.col("field_name").isin(columns))
    rows = funnel_ratios(present).orderBy("num_pos", "den_pos").collect()
    return [(r["field_name"], r["numerator"], r["denominator"]) for r in rows if r["field_name"] not in columns]


def add_ratios(df: DataFrame, ratios: list[tuple[str, str, str]]) -> DataFrame:
    """All ratio columns in one projection; 0.0 over an empty denominator."""
    if not ratios:
        return df
    return df.withColumns({name: ratio_or_zero(F.col(num), F.col(den)) for name, num, den in ratios})


def null_share_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, pct_null) of every ratio from one aggregate."""
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns])
    return tidy(
        wide,
        [
            {"metric": F.lit(c), "pct_null": F.round(F.coalesce(F.try_divide(100 * F.col(f"n_{c}"), F.col("n")), F.lit(0.0)), 2)}
            for c in columns
        ],
    )
