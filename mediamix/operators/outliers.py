"""Outlier detection and treatment per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.catalog import Catalog
from mediamix.functions.scalars import clip
from mediamix.grain import Grain, join_measured, join_on, tidy
from mediamix.operators.quantiles import ACCURACY, quantile_column, segment_quantiles
from mediamix.operators.series import fill_series, trailing_mean
from mediamix.session import cut_lineage

# Fixed values.
IQR_FACTOR = 1.5
Z_LIMIT = 3.0
WINSOR = (0.01, 0.99)
QUARTILES = (0.25, 0.75)
SMOOTH_ROWS = 3

LOW, Q1, Q3, HIGH = range(4)
PROBABILITIES = (WINSOR[0], *QUARTILES, WINSOR[1])


def with_bounds(df: DataFrame, grain: Grain, quantile_columns: Sequence[str], moment_columns: Sequence[str] = ()) -> DataFrame:
    """Attach the segment's quantiles and moments to its rows.

    With a unique grain a segment is as long as the calendar, and one window, on the
    partitioning the fills need anyway, avoids computing the input twice.  Otherwise: one
    aggregate, written out because its size decides on the join.
    """
    keys = list(grain.keys)
    if grain.unique:
        segment = grain.whole()
        arrays = {
            f"__all_{c}": F.percentile_approx(c, list(PROBABILITIES), ACCURACY).over(segment) for c in quantile_columns
        }
        spread = {
            name: value.over(segment)
            for c in moment_columns
            for name, value in ((f"__mean_{c}", F.avg(c)), (f"__std_{c}", F.stddev_samp(c)))
        }
        picked = {
            quantile_column(c, i): F.col(f"__all_{c}")[i] for c in quantile_columns for i in range(len(PROBABILITIES))
        }
        wide = df.withColumns({**arrays, **spread})
        return wide.withColumns(picked).drop(*arrays) if picked else wide
    moments = [
        c
        for name in moment_columns
        for c in (F.avg(name).alias(f"__mean_{name}"), F.stddev_samp(name).alias(f"__std_{name}"))
    ]
    stats = None
    if quantile_columns:
        stats = segment_quantiles(df, grain, {c: F.col(c) for c in quantile_columns}, PROBABILITIES)
    if moments:
        spread = df.groupBy(*keys).agg(*moments)
        stats = spread if stats is None else join_on(stats, spread, keys)
    if stats is None:
        return df
    stats = cut_lineage(stats)
    return join_measured(df, stats, keys, row_bytes=8 * len(stats.columns) + 64, how="left")


def drop_bounds(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def iqr_mask(name: str, factor: float = IQR_FACTOR) -> Column:
    """True outside the quartile fences; null for a null value."""
    q1, q3 = F.col(quantile_column(name, Q1)), F.col(quantile_column(name, Q3))
    reach = factor * (q3 - q1)
    return (F.col(name) < q1 - reach) | (F.col(name) > q3 + reach)


def zscore_mask(name: str, limit: float = Z_LIMIT) -> Column:
    """True beyond ``limit`` deviations; false for a segment without spread."""
    mean, std = F.col(f"__mean_{name}"), F.col(f"__std_{name}")
    return F.when(std.isNull() | (std == 0), False).otherwise(F.abs(F.col(name) - mean) / std > limit)


MASKS = {"iqr": iqr_mask, "zscore": zscore_mask}


def winsorized(name: str, null_to_lower: bool = False) -> Column:
    low, high = F.col(quantile_column(name, LOW)), F.col(quantile_column(name, HIGH))
    held = clip(F.col(name), low, high)
    return F.coalesce(held, low) if null_to_lower else held


def winsorize(df: DataFrame, grain: Grain, columns: Sequence[str], null_to_lower: bool = False) -> DataFrame:
    """Hold every value within its segment's 1 % and 99 % quantiles."""
    bounded = with_bounds(df, grain, columns)
    return drop_bounds(bounded.withColumns({c: winsorized(c, null_to_lower) for c in columns}))


def without_outliers(name: str, detection: str) -> Column:
    if detection not in MASKS:
        raise ValueError(f"unknown detection {detection!r}; use one of {sorted(MASKS)}")
    return F.when(~F.coalesce(MASKS[detection](name), F.lit(False)), F.col(name))


def forward_fill_outliers(df: DataFrame, grain: Grain, columns: Sequence[str], detection: str = "iqr") -> DataFrame:
    """Replace outliers and nulls by the last value before them that is neither."""
    if detection not in MASKS:
        raise ValueError(f"unknown detection {detection!r}; use one of {sorted(MASKS)}")
    bounded = with_bounds(df, grain, columns if detection == "iqr" else (), columns if detection == "zscore" else ())
    filled = fill_series(bounded, grain, {c: (without_outliers(c, detection), "forward_fill") for c in columns})
    return drop_bounds(filled)


def _by_rule(catalog: Catalog) -> dict[str, list[str]]:
    return {rule: catalog.fields(outlier_rule=rule) for rule in ("winsorize", "forward_fill", "smooth")}


def treat_outliers(df: DataFrame, grain: Grain, catalog: Catalog) -> DataFrame:
    """Apply each metric's outlier rule.

    One aggregate for all quantiles, one join to bring them back, and one window
    partitioning for the fills and the trailing means of all metrics.
    """
    rules = _by_rule(catalog)
    bounded = with_bounds(df, grain, rules["winsorize"] + rules["forward_fill"])
    clipped = bounded.withColumns({c: winsorized(c) for c in rules["winsorize"]}) if rules["winsorize"] else bounded
    filled = fill_series(clipped, grain, {c: (without_outliers(c, "iqr"), "forward_fill") for c in rules["forward_fill"]})
    return drop_bounds(trailing_mean(filled, grain, {c: F.col(c) for c in rules["smooth"]}, SMOOTH_ROWS))


def outlier_report(df: DataFrame, grain: Grain, catalog: Catalog) -> DataFrame:
    """(metric, category, n_outliers, n_rows, pct) of every metric with an outlier rule."""
    rules = _by_rule(catalog)
    fenced, scored = rules["winsorize"] + rules["forward_fill"], rules["smooth"]
    bounded = with_bounds(df, grain, fenced, scored)
    masks = {**{c: iqr_mask(c) for c in fenced}, **{c: zscore_mask(c) for c in scored}}
    wide = bounded.agg(
        F.count("*").alias("n_rows"), *[F.count_if(mask).alias(f"n_{c}") for c, mask in masks.items()]
    )
    category = {m.field: m.category for m in catalog}
    return tidy(
        wide,
        [
            {
                "metric": F.lit(c),
                "category": F.lit(category[c]),
                "n_outliers": F.col(f"n_{c}"),
                "n_rows": F.col("n_rows"),
                "pct": F.round(F.try_divide(100 * F.col(f"n_{c}"), F.col("n_rows")), 2),
            }
            for c in masks
        ],
    )
