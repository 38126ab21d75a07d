"""Writing panels, catalogues, registries and model selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.operators.conform import chronological
from mediamix.operators.signals import nested_registry


def write_panel(df: DataFrame, path: str, format: str = "parquet", by_segment: bool = False) -> None:
    """Overwrite ``path`` with the panel, in as many files as its partitions.

    With ``by_segment`` there is one folder per segment, its rows in date order.
    """
    out = chronological(df, "date") if by_segment else df
    writer = out.write.mode("overwrite")
    if by_segment:
        writer = writer.partitionBy("segment")
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)


def write_catalog(catalog: DataFrame, path: str) -> None:
    catalog.orderBy("pos").write.mode("overwrite").option("header", True).csv(path)


def write_registry(registry: DataFrame, path: str, catalog: DataFrame | None = None) -> None:
    """One JSON document: global response, global controls and channels, with ``catalog`` all of its channels."""
    nested_registry(registry, catalog).write.mode("overwrite").json(path)


def write_selections(best: DataFrame, path: str) -> None:
    """One JSON row per segment with its best solution."""
    best.select("segment", "sol_id", "score").write.mode("overwrite").json(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """One row per scored solution with all measures, parts, notes and its rank."""
    scores.write.mode("overwrite").parquet(path)


def write_weekly(weekly: DataFrame, path: str) -> None:
    """Weekly series of solutions (segment, sol_id, date, component, value), a folder per segment."""
    weekly.repartition("segment").sortWithinPartitions("segment", "sol_id", "date").write.mode("overwrite").partitionBy("segment").parquet(path)


def write_params(params: DataFrame, path: str) -> None:
    """One JSON row per segment with the winner's parameters."""
    params.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
