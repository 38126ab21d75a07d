"""Type-aware aggregation to the panel's grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.catalog import Catalog, Metric
from mediamix.grain import require_columns


def weighted_mean(value: str, weight: str) -> Column:
    """Weighted mean, the plain mean where the weights do not add up to more than 0."""
    total = F.sum(weight)
    return F.when(total > 0, F.sum(F.col(value) * F.col(weight)) / total).otherwise(F.avg(value))


def aggregate_column(metric: Metric) -> Column:
    """The one aggregate expression of a metric."""
    if metric.aggregate_rule == "sum":
        return F.sum(metric.field)
    if metric.aggregate_rule == "max":
        return F.max(metric.field)
    if metric.aggregate_rule == "weighted_mean" and metric.weight:
        return weighted_mean(metric.field, metric.weight)
    if metric.aggregate_rule in ("weighted_mean", "mean"):
        return F.avg(metric.field)
    raise ValueError(f"no aggregate for data_type {metric.data_type!r} of metric {metric.field!r}")


def aggregate_panel(df: DataFrame, keys: Sequence[str], catalog: Catalog) -> DataFrame:
    """All metrics of the catalogue on the same keys: a single partial + final aggregate."""
    require_columns(df, keys, "aggregation keys")
    metrics = [m for m in catalog if m.field in df.columns and m.field not in keys]
    if not metrics:
        raise ValueError("no metric to aggregate")
    return df.groupBy(*keys).agg(*[aggregate_column(m).alias(m.field) for m in metrics])


def merge_metric_frames(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of frames that are unique on ``keys``; null keys match.

    A frame with two rows on one key is an error when the result is computed.

    A union and one grouped pick instead of a chain of outer joins: one shuffle for any
    number of frames.
    """
    values: list[str] = []
    for frame in frames:
        require_columns(frame, keys, "merge keys")
        new = [c for c in frame.columns if c not in keys]
        twice = sorted(set(new) & set(values))
        if twice:
            raise ValueError(f"frames share value columns {twice}")
        values += new
    numbered = [frame.withColumn("__frame", F.lit(i)) for i, frame in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    merged = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in values],
        F.array(*[F.count_if(F.col("__frame") == i) for i in range(len(frames))]).alias("__rows"),
    )
    unique = F.when(F.array_max("__rows") <= 1, True).otherwise(
        F.raise_error(F.lit(f"merge: a frame has several rows on one of {list(keys)}")).cast("boolean")
    )
    return merged.filter(unique).drop("__rows")
