"""From the processed panel and the registry to a model-ready panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.grain import require_columns, tidy


def correlation(x: str, y: str, absolute: bool = False) -> Column:
    """Pearson correlation with nulls as 0; 0 where either side is constant."""
    a, b = F.coalesce(F.col(x).cast("double"), F.lit(0.0)), F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    value = F.coalesce(
        F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)), F.lit(0.0)
    )
    return F.abs(value) if absolute else value


def exposure_correlations(
    df: DataFrame, exposures: Sequence[tuple[str, str]], target: str, absolute: bool = False
) -> DataFrame:
    """(channel, field_name, rank, corr) of all exposures, from one aggregate.

    ``exposures`` are (channel, field) pairs in preference order; fields the panel lacks
    are skipped.
    """
    require_columns(df, [target], "target")
    known = [(i, c, f) for i, (c, f) in enumerate(exposures) if f in df.columns]
    wide = df.agg(*[correlation(f, target, absolute).alias(f"corr_{i}") for i, _, f in known])
    return tidy(
        wide,
        [
            {"channel": F.lit(c), "field_name": F.lit(f), "rank": F.lit(i), "corr": F.col(f"corr_{i}")}
            for i, c, f in known
        ],
    )


def best_exposures(correlations: DataFrame) -> DataFrame:
    """(channel, field_name, corr): the highest correlation, the first of equals."""
    order = F.struct("corr", -F.col("rank"))
    return correlations.groupBy("channel").agg(
        F.max_by("field_name", order).alias("field_name"), F.round(F.max("corr"), 4).alias("corr")
    )


def with_best_exposures(registry: DataFrame, best: DataFrame) -> DataFrame:
    """Registry in which each channel keeps only its best exposure.

    Channels none of whose exposures are in the panel keep what they had.
    """
    chosen = best.select(
        F.lit("exposure").alias("role"), "channel", F.lit(1).alias("rank"), "field_name", F.lit(None).cast("string").alias("tier")
    )
    rest = registry.join(chosen.select("role", "channel"), ["role", "channel"], "left_anti")
    return rest.unionByName(chosen.select(rest.columns))


def segment_key(keys: Sequence[str]) -> Column:
    """Keys joined by underscores; a null key leaves its place empty."""
    return F.concat_ws("_", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def segments(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(segment_key(keys).alias("segment")).distinct()


def model_columns(registry: DataFrame) -> list[str]:
    """Target, controls, exposures and spends in that order; one row per column to collect."""
    section = F.element_at(
        F.create_map(
            *[
                F.lit(v)
                for pair in zip(["global_response", "global_control", "exposure", "spend"], range(4))
                for v in pair
            ]
        ),
        F.col("role"),
    )
    rows = (
        registry.filter(F.col("role") != "response")
        .orderBy(section, "channel", "rank")
        .select("field_name")
        .collect()
    )
    return list(dict.fromkeys(r["field_name"] for r in rows))


def model_ready_panel(df: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str]) -> DataFrame:
    """Date, segment and the model's columns; columns the panel lacks are left out."""
    require_columns(df, [*keys, date], "segment keys")
    kept = [c for c in dict.fromkeys(columns) if c in df.columns and c not in (date, "segment")]
    return df.select(date, segment_key(keys).alias("segment"), *kept)


def chronological(df: DataFrame, date: str) -> DataFrame:
    """Rows of a segment together and by date within files; no global sort.

    Range partitioning on both columns, so a large segment spreads over several tasks.
    """
    return df.repartitionByRange("segment", date).sortWithinPartitions("segment", date)


def model_spec(registry: DataFrame) -> DataFrame:
    """(channel, spend, exposure): the first of each, for channels that have both."""
    first = registry.filter(F.col("rank") == 1)
    spends = first.filter(F.col("role") == "spend").select("channel", F.col("field_name").alias("spend"))
    exposures = first.filter(F.col("role") == "exposure").select("channel", F.col("field_name").alias("exposure"))
    return spends.join(exposures, "channel")


def check_signs(controls: Sequence[str], signs: Sequence[str]) -> dict[str, str]:
    """Sign constraint of each control; both lists must have one entry per control."""
    if len(controls) != len(signs):
        raise ValueError(f"{len(signs)} signs for {len(controls)} controls {list(controls)}")
    unknown = sorted(set(signs) - {"default", "positive", "negative"})
    if unknown:
        raise ValueError(f"unknown signs {unknown}")
    return dict(zip(controls, signs))
