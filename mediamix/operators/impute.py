"""Missing values, filled by the catalogue's rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.catalog import Catalog
from mediamix.grain import Grain, tidy
from mediamix.operators.checks import spend_response_pairs
from mediamix.operators.rules import RATE_TYPES
from mediamix.operators.series import fill_series


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns) if columns else df


def guarded_spend(spend: str, responses: list[str]) -> Column:
    """Spend with nulls as 0; fails while a response of the channel is above 0.

    The guard is part of the expression, so it costs no job of its own.
    """
    filled = F.coalesce(F.col(spend), F.lit(0))
    for response in responses:
        clash = F.col(spend).isNull() & (F.col(response) > 0)
        message = F.lit(f"{response} was measured in a period without a figure for {spend}")
        filled = F.when(clash, F.raise_error(message)).otherwise(filled)
    return filled


def impute(df: DataFrame, grain: Grain, catalog: Catalog, edge: str = "null", guard: bool = True) -> DataFrame:
    """Fill every metric by its rule; all series fills share one window partitioning.

    ``edge='hold'`` also fills macro values before the first and after the last known
    one; ``guard=False`` fills spend gaps without looking at responses.
    """
    interpolate = {"null": "interpolate", "hold": "interpolate_hold"}[edge]
    fills = {m.field: (F.col(m.field), "nearest_known") for m in catalog.where(fill_rule="nearest_known")}
    fills |= {m.field: (F.col(m.field), interpolate) for m in catalog.where(fill_rule="interpolate")}
    series = fill_series(df, grain, fills)
    responses: dict[str, list[str]] = {}
    for _, spend, response in spend_response_pairs(catalog):
        responses.setdefault(spend, []).append(response)
    columns = {c: F.coalesce(F.col(c), F.lit(0)) for c in catalog.fields(fill_rule="zero")}
    columns |= {
        c: guarded_spend(c, responses.get(c, []) if guard else []) for c in catalog.fields(fill_rule="guarded_zero")
    }
    return series.withColumns(columns) if columns else series


def rate_fill_report(df: DataFrame, catalog: Catalog) -> DataFrame:
    """(metric, n_spend_gap, n_other): why each rate was filled with 0.

    ``n_spend_gap`` rows have a channel spend of 0, ``n_other`` rows do not.
    """
    rates = catalog.where(category="response", data_type=RATE_TYPES)
    spends = catalog.where(category="spend", data_type="absolute")
    aggregates = []
    for m in rates:
        idle = F.lit(False)
        for s in spends:
            if m.channel is not None and s.channel == m.channel:
                idle = idle | F.coalesce(F.col(s.field) == 0, F.lit(False))
        missing = F.col(m.field).isNull()
        aggregates += [F.count_if(missing & idle).alias(f"gap_{m.field}"), F.count_if(missing & ~idle).alias(f"other_{m.field}")]
    return tidy(
        df.agg(*aggregates),
        [
            {"metric": F.lit(m.field), "n_spend_gap": F.col(f"gap_{m.field}"), "n_other": F.col(f"other_{m.field}")}
            for m in rates
        ],
    )


def missing_report(df: DataFrame, grain: Grain, catalog: Catalog, **options) -> DataFrame:
    """(metric, category, rule, n_before, n_after) from one pass over filled rows."""
    metrics = [m for m in catalog if m.fill_rule != "leave"]
    marked = df.withColumns({f"__was_null_{m.field}": F.col(m.field).isNull() for m in metrics})
    wide = impute(marked, grain, catalog, **options).agg(
        *[F.count_if(F.col(f"__was_null_{m.field}")).alias(f"before_{m.field}") for m in metrics],
        *[F.count_if(F.col(m.field).isNull()).alias(f"after_{m.field}") for m in metrics],
    )
    return tidy(
        wide,
        [
            {
                "metric": F.lit(m.field),
                "category": F.lit(m.category),
                "rule": F.lit(m.fill_rule),
                "n_before": F.col(f"before_{m.field}"),
                "n_after": F.col(f"after_{m.field}"),
            }
            for m in metrics
        ],
    )
