"""Validation reports: every check of a stage is one aggregate over the panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mediamix.catalog import NOT_A_METRIC, YES_NO, Catalog
from mediamix.functions.scalars import flag_is_bad, flag_value
from mediamix.grain import tidy
from mediamix.operators.rules import FLAG_TYPES
from mediamix.session import cut_lineage


def non_negative_metrics(catalog: Catalog) -> list[str]:
    """Metrics that must not be negative; a bad or missing setting is an error."""
    found = []
    for m in catalog:
        if m.category in NOT_A_METRIC or m.field == "date":
            continue
        if m.can_be_negative not in YES_NO:
            raise ValueError(f"can_be_negative is {m.can_be_negative!r} for metric {m.field!r}; use Yes or No")
        if m.can_be_negative in ("no", "n"):
            found.append(m.field)
    return found


def _count_report(df: DataFrame, conditions: list[tuple[dict, object]], count_name: str) -> DataFrame:
    wide = df.agg(*[F.count_if(c).alias(f"n{i}") for i, (_, c) in enumerate(conditions)])
    return tidy(
        wide,
        [
            {**{k: F.lit(v) for k, v in labels.items()}, count_name: F.col(f"n{i}")}
            for i, (labels, _) in enumerate(conditions)
        ],
    )


def negativity_report(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric, n_bad): rows below zero; nulls pass."""
    return _count_report(df, [({"metric": m}, F.col(m) < 0) for m in metrics], "n_bad")


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, n_null) for every value column."""
    return _count_report(df, [({"metric": c}, F.col(c).isNull()) for c in columns], "n_null")


def spend_response_pairs(catalog: Catalog) -> list[tuple[str, str, str]]:
    """(channel, spend, response) for the absolute metrics of each channel."""
    responses = catalog.where(category="response", data_type="absolute")
    return [
        (s.channel, s.field, r.field)
        for s in catalog.where(category="spend", data_type="absolute")
        for r in responses
        if s.channel is not None and s.channel == r.channel
    ]


def spend_response_conflicts(df: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(kind, channel, spend, response, n_rows).

    ``warning``: response without spend; ``error``: response while spend is unknown.
    """
    conditions = []
    for channel, spend, response in pairs:
        labels = {"channel": channel, "spend": spend, "response": response}
        active = F.col(response) > 0
        conditions.append(({"kind": "warning", **labels}, active & (F.col(spend) == 0)))
        conditions.append(({"kind": "error", **labels}, active & F.col(spend).isNull()))
    return _count_report(df, conditions, "n_rows")


def flag_columns(df: DataFrame, catalog: Catalog) -> list[str]:
    """Flag metrics stored as text."""
    kinds = dict(df.dtypes)
    return [f for f in catalog.fields(data_type=FLAG_TYPES) if kinds.get(f) == "string"]


def normalize_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: flag_value(F.col(c)) for c in columns}) if columns else df


def flag_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n_rows) of flag texts that are neither a yes nor a no.

    Counted per value with map-side combine, so free text in a flag column spreads over
    the cluster instead of filling one set.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .filter(flag_is_bad(F.col("value")))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


class Observed:
    """Counts of bad rows that are taken while a plan runs for another purpose.

    ``rows`` passes ``df`` on; the counts are there once any action has read all of it, and
    cost no pass of their own.
    """

    def __init__(self, df: DataFrame, conditions: Sequence[Column]):
        self._observation = Observation() if conditions else None
        counts = [F.count_if(c).alias(f"n{i}") for i, c in enumerate(conditions)]
        self.rows = df.observe(self._observation, *counts) if conditions else df

    def total(self, places: Sequence[int]) -> int:
        """Bad rows under the conditions at these places."""
        found = self._observation.get if places else {}
        return sum(found[f"n{i}"] for i in places)


def observe_raw(df: DataFrame, flags: Sequence[str], metrics: Sequence[str]) -> Observed:
    """Flag texts that are no flags, then values of ``metrics`` below zero."""
    return Observed(df, [*(flag_is_bad(F.col(c).cast("string")) for c in flags), *(F.col(m) < 0 for m in metrics)])


def observe_nulls(df: DataFrame, columns: Sequence[str]) -> Observed:
    return Observed(df, [F.col(c).isNull() for c in columns])


def repeated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, n_rows) of what more than one row has."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


# Offending rows that an error message spells out.
SHOWN = 20


def raise_if_any(report: DataFrame, count: str, what: str) -> None:
    """Fail with the number of offending rows of a report and the first of them.

    If there are more, all of them stay readable in a table that the message names.
    """
    bad = report.filter(F.col(count) > 0)
    first = bad.limit(SHOWN + 1).collect()
    if not first:
        return
    if len(first) <= SHOWN:
        raise ValueError(f"{what}: {[r.asDict() for r in first]}")
    kept = cut_lineage(bad)
    raise ValueError(f"{what}: {kept.count()} cases, all in {kept.inputFiles()[0].rpartition('/')[0]}; the first: {[r.asDict() for r in first[:SHOWN]]}")
