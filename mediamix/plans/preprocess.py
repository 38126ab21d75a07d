"""Raw daily panel to weekly panel, extended catalogue and candidate registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from mediamix.catalog import Catalog, extend_catalog, present_metrics
from mediamix.functions.frequency import Frequency, parse_frequency
from mediamix.grain import Grain
from mediamix.operators import checks, funnel, signals
from mediamix.operators.aggregate import aggregate_panel
from mediamix.operators.calendar import convert_grain, fill_calendar, normalize_columns, parse_dates
from mediamix.operators.impute import impute
from mediamix.operators.outliers import treat_outliers
from mediamix.operators.rules import plan_catalog
from mediamix.session import cut_lineage


@dataclass(frozen=True)
class Options:
    start: str | Frequency = "daily"
    end: str | Frequency = "weekly"
    week_label: str = "iso_minus_1"
    macro_edge: str = "null"
    longest_match: bool = False
    absolute_conversions_as_response: bool = False


@dataclass(frozen=True)
class Prepared:
    """Weekly panel with ratios, the catalogue extended by them, and the candidates."""

    panel: DataFrame
    catalog: DataFrame
    registry: DataFrame


def clean_daily(raw: DataFrame, grain: Grain, plan: Catalog, options: Options = Options()) -> DataFrame:
    """Dates and flags normalised, outliers treated, calendar filled, gaps imputed; lazy."""
    dated = parse_dates(normalize_columns(raw), grain.date)
    flagged = checks.normalize_flags(dated, checks.flag_columns(dated, plan))
    treated = treat_outliers(flagged, grain, plan)
    continuous = fill_calendar(treated, grain, options.start)
    return impute(continuous, grain, plan, edge=options.macro_edge)


def weekly_panel(raw: DataFrame, grain: Grain, plan: Catalog, options: Options = Options()) -> DataFrame:
    """Clean daily rows on the target grain, all metrics in one aggregate; lazy."""
    daily = clean_daily(raw, grain, plan, options)
    coarse = convert_grain(daily, grain.date, options.start, options.end, options.week_label)
    return aggregate_panel(coarse, grain.columns, plan)


def preprocess(raw: DataFrame, catalog: DataFrame, grain: Grain, options: Options = Options()) -> Prepared:
    """Run the stage with its checks.

    Metrics of the catalogue that the data lacks take no part. Flags, signs and nulls are
    counted while the weekly panel is computed and written once to the checkpoint folder, so
    these checks read nothing of their own; a stage with bad rows fails after that, with the
    report that names them. A grain that is stated unique is checked by a pass of its own.
    """
    parse_frequency(options.end)
    named = normalize_columns(raw)
    catalog = present_metrics(catalog, named.columns)
    plan = plan_catalog(catalog, named.columns)
    if grain.unique:
        checks.raise_if_any(checks.repeated_rows(parse_dates(named, grain.date), grain.columns), "n_rows", "not unique on the grain")
    flags = checks.flag_columns(named, plan)
    numeric = [m for m in checks.non_negative_metrics(plan) if m not in flags]
    raw_rows = checks.observe_raw(named, flags, numeric)
    weekly_rows = weekly_panel(raw_rows.rows, grain, plan, options)
    values = [c for c in weekly_rows.columns if c not in grain.columns]
    audited = checks.observe_nulls(weekly_rows, values)
    weekly = cut_lineage(audited.rows)
    # the reports that name what is wrong are only made where something is
    if raw_rows.total(range(len(flags))):
        checks.raise_if_any(checks.flag_violations(named, flags), "n_rows", "bad flag values")
    if raw_rows.total(range(len(flags), len(flags) + len(numeric))):
        checks.raise_if_any(checks.negativity_report(named, numeric), "n_bad", "negative values")
    if audited.total(range(len(values))):
        checks.raise_if_any(checks.null_audit(weekly, values), "n_null", "missing values after imputation")

    ratios = funnel.funnel_ratios(catalog)
    planned = funnel.plan_ratios(catalog, weekly.columns)
    panel = funnel.add_ratios(weekly, planned)
    created = [name for name, _, _ in planned]
    extended = extend_catalog(
        catalog, funnel.derived_metrics(ratios).filter(ratios["field_name"].isin(created))
    )
    metrics = [c for c in panel.columns if c not in grain.columns]
    quality = signals.metric_quality(panel, metrics)
    registry = signals.candidate_registry(
        signals.require_channels(extended),
        cut_lineage(quality),
        longest=options.longest_match,
        absolute_conversions_as_response=options.absolute_conversions_as_response,
    )
    return Prepared(panel, extended, cut_lineage(registry))
