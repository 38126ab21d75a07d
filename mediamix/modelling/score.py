"""Business scores of solutions and the best one per segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.functions.scalars import EPSILON
from mediamix.grain import in_order, join_on
from mediamix.modelling.decompose import FITTED, KEYS, TARGET, channels_of

# Score weights and limits.
WEIGHTS = {
    "roas_norm": 0.25,
    "rssd_norm": 0.18,
    "media_pct_norm": 0.12,
    "roas_cv_norm": 0.12,
    "dominance_norm": 0.10,
    "share_delta_norm": 0.08,
    "carryover_norm": 0.05,
    "r2_norm": 0.05,
    "nrmse_norm": 0.05,
    "overfit_penalty": -0.10,
}
MIN_RSQ = 0.5
OVERFIT_FROM, OVERFIT_SPAN = 0.95, 0.05
ROAS_CAP = 8
LOW_ROAS = 1
LOW_CHANNEL_ROAS = 0.3
LOW_MEDIA = 0.15
DOMINANT = 0.5
HIGH_CARRYOVER = 0.6


def channel_scores(channels: DataFrame) -> DataFrame:
    """Per solution: blended ROAS and its spread, dominance, share gap, carryover.

    One aggregate for all of them.  ``channels`` has one row per solution and paid
    channel.  Solutions of equal channels have equal scores to the last bit.
    """
    weighted = F.sum(F.col("roi_total") * F.col("spend_share"))
    spread = F.stddev_samp("roi_total") / (F.abs(F.avg("roi_total")) + EPSILON)
    return in_order(channels, KEYS, ["channel"]).groupBy(*KEYS).agg(
        (weighted / (F.sum("spend_share") + EPSILON)).alias("roas"),
        F.coalesce(spread, F.lit(0.0)).alias("roas_cv"),
        F.max("effect_share").alias("max_channel_effect_share"),
        F.max(F.abs(F.col("effect_share") - F.col("spend_share"))).alias("max_share_delta"),
        (F.sum("mean_carryover") / (F.sum("mean_spend_adstocked") + EPSILON)).alias("carryover_pct"),
        F.max_by("channel", F.struct("effect_share", "channel")).alias("top_channel"),
        F.array_sort(F.collect_list(F.when(F.col("roi_total") < LOW_CHANNEL_ROAS, F.col("channel")))).alias(
            "low_roas_channels"
        ),
    )


def baseline_scores(weekly: DataFrame, not_baseline: Sequence[str]) -> DataFrame:
    """Per solution: smallest and mean baseline and the share of it in the target.

    The baseline of a date is the sum of all components other than media, context and
    organic ones, the target and the fit.
    """
    excluded = [*not_baseline, FITTED]
    is_base = F.col("component") != TARGET
    dates = (
        in_order(weekly.filter(~F.col("component").isin(excluded)), [*KEYS, "date"], ["component"])
        .groupBy(*KEYS, "date")
        .agg(
            F.coalesce(F.sum(F.when(is_base, F.col("value"))), F.lit(0.0)).alias("baseline"),
            F.sum(F.when(~is_base, F.col("value"))).alias("target"),
        )
    )
    return (
        in_order(dates, KEYS, ["date"])
        .groupBy(*KEYS)
        .agg(
            F.min("baseline").alias("baseline_min_weekly"),
            F.avg("baseline").alias("baseline_mean_weekly"),
            F.avg(F.col("baseline") / (F.col("target") + EPSILON)).alias("baseline_pct_mean"),
        )
        .withColumn("media_contribution_pct", 1 - F.col("baseline_pct_mean"))
    )


def viability(measures: DataFrame) -> DataFrame:
    """Add ``disqualified``, ``tier`` and ``viable``.

    Negative baselines and poor fits are out.  A segment with nothing left falls back to
    its solutions with a baseline of at least 0, then to all of them: the lowest tier
    that has a solution is viable.
    """
    negative = F.coalesce(F.col("baseline_min_weekly") < 0, F.lit(False))
    poor = F.coalesce(F.col("rsq_train") < MIN_RSQ, F.lit(False))
    based = F.coalesce(F.col("baseline_min_weekly") >= 0, F.lit(False))
    tier = F.when(~negative & ~poor, 0).when(based, 1).otherwise(2)
    marked = measures.withColumns({"disqualified": negative | poor, "tier": tier})
    best = marked.groupBy("segment").agg(F.min("tier").alias("__tier"))
    return (
        join_on(marked, best, ["segment"]).withColumn("viable", F.col("tier") == F.col("__tier")).drop("__tier")
    )


def _scaled(measure: str, higher_is_better: bool) -> Column:
    low, high = F.col(f"__low_{measure}"), F.col(f"__high_{measure}")
    place = (F.col(measure) - low) / (high - low + EPSILON)
    return place if higher_is_better else 1 - place


def _clipped(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def score_parts(viable: DataFrame) -> DataFrame:
    """Add the normalised parts and the score to the viable solutions."""
    scales = {
        "roas_cv_norm": ("roas_cv", False),
        "media_pct_norm": ("media_contribution_pct", True),
        "rssd_norm": ("decomp_rssd", False),
        "dominance_norm": ("max_channel_effect_share", False),
        "share_delta_norm": ("max_share_delta", False),
        "carryover_norm": ("carryover_pct", False),
        "r2_norm": ("rsq_train", True),
        "nrmse_norm": ("nrmse", False),
    }
    ranges = viable.groupBy("segment").agg(
        *[e for m, _ in scales.values() for e in (F.min(m).alias(f"__low_{m}"), F.max(m).alias(f"__high_{m}"))]
    )
    parts = {name: _scaled(measure, better) for name, (measure, better) in scales.items()}
    parts["roas_norm"] = _clipped(F.col("roas"), 0, ROAS_CAP) / ROAS_CAP
    parts["overfit_penalty"] = _clipped((F.col("rsq_train") - OVERFIT_FROM) / OVERFIT_SPAN, 0, 1)
    scored = join_on(viable, ranges, ["segment"]).withColumns(parts)
    score = sum((w * F.col(p) for p, w in WEIGHTS.items()), F.lit(0.0))
    return scored.withColumn("score", score).drop(*[c for c in scored.columns if c.startswith("__")])


def notes() -> Column:
    """Remarks on a solution, joined by `` | ``."""

    def percent(name: str) -> Column:
        return F.format_string("%.0f%%", F.col(name) * 100)

    few = F.concat(F.lit("weak channels (return under 0.3): "), F.array_join("low_roas_channels", ", "))
    return F.concat_ws(
        " | ",
        F.when(F.col("roas") < LOW_ROAS, F.concat(F.lit("return "), F.format_string("%.2f", "roas"), F.lit(" is under 1"))),
        F.when(F.size("low_roas_channels") > 0, few),
        F.when(
            F.col("media_contribution_pct") < LOW_MEDIA,
            F.concat(F.lit("small media part: "), percent("media_contribution_pct")),
        ),
        F.when(
            F.col("max_channel_effect_share") > DOMINANT,
            F.concat(F.col("top_channel"), F.lit(" has "), percent("max_channel_effect_share"), F.lit(" of the effect")),
        ),
        F.when(F.col("carryover_pct") > HIGH_CARRYOVER, F.concat(F.lit("carried over: "), percent("carryover_pct"))),
        F.when(F.col("rsq_train") > OVERFIT_FROM, F.concat(F.lit("may overfit, r2 "), F.format_string("%.3f", "rsq_train"))),
    )


def measure_summaries(summaries: DataFrame) -> DataFrame:
    """``measure_solutions`` of ``decompose.decompose_solutions``, which has the baselines already."""
    base = summaries.select(
        *KEYS,
        *["nrmse", "decomp_rssd", "rsq_train", "baseline_min_weekly", "baseline_mean_weekly", "baseline_pct_mean"],
        (1 - F.col("baseline_pct_mean")).alias("media_contribution_pct"),
    )
    return join_on(base, channel_scores(channels_of(summaries)), KEYS, "left")


def measure_solutions(
    fits: DataFrame, channels: DataFrame, weekly: DataFrame, not_baseline: Sequence[str]
) -> DataFrame:
    """All measures of each solution side by side.

    ``fits``: (segment, sol_id, nrmse, decomp_rssd, rsq_train).
    """
    base = fits.select(*KEYS, "nrmse", "decomp_rssd", "rsq_train")
    return join_on(
        join_on(base, channel_scores(channels), KEYS, "left"), baseline_scores(weekly, not_baseline), KEYS, "left"
    )


def model_scores(measures: DataFrame) -> DataFrame:
    """Viable solutions with score, rank within the segment, notes and eliminated peers.

    Solutions per segment are the winners of at most ten clusters.
    """
    marked = viability(measures)
    order = Window.partitionBy("segment").orderBy(F.col("score").desc_nulls_last(), "sol_id")
    eliminated = marked.groupBy("segment").agg(
        F.array_sort(F.collect_list(F.when(F.col("disqualified"), F.col("sol_id")))).alias("__out")
    )
    scored = score_parts(marked.filter("viable")).withColumns(
        {"rank": F.row_number().over(order), "notes": notes()}
    )
    peers = F.when(F.size("__out") == 0, "none").otherwise(F.array_join("__out", ", "))
    return join_on(scored, eliminated, ["segment"]).withColumn("eliminated_peers", peers).drop("__out")


def best_models(scores: DataFrame) -> DataFrame:
    """(segment, sol_id, score) of the best solution per segment."""
    return scores.filter(F.col("rank") == 1).select("segment", "sol_id", "score")


def winner_params(
    best: DataFrame,
    fits: DataFrame,
    params: DataFrame,
    channels: DataFrame,
    exposure_fits: DataFrame,
    weekly: DataFrame | None = None,
    exposures: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per segment: fit metrics, maps from channel to its parameters, weekly series.

    ``params``: (segment, sol_id, channel, alpha, gamma, theta).  Maps hold one entry per
    channel of the model.  ``mm_params`` of a channel without a fit is null; with
    ``exposures`` (channel to column) it names the exposure column of each fit.  With
    ``weekly`` (segment, sol_id, date, component, value) the record has ``weekly_decomp``,
    one entry per date of the calendar in order, components by name.
    """

    def by_channel(name: str, value: Column) -> Column:
        entry = F.struct(F.col("channel").alias("key"), value.alias("value"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name)

    won = best.select(*KEYS)
    merged = (
        channels.join(won, KEYS, "left_semi")
        .join(params, [*KEYS, "channel"], "left")
        .join(exposure_fits, ["segment", "channel"], "left")
    )
    names = F.create_map(*[F.lit(x) for item in (exposures or {"": ""}).items() for x in item])
    merged = merged.withColumn("exposure_col", F.try_element_at(names, F.col("channel")))
    fitted = F.struct("model_type", "vmax", "km", "coef_lm", "rsq", "exposure_col", "km_ratio", "use_mm", "km_edge")
    maps = merged.groupBy(*KEYS).agg(
        by_channel("hill_params", F.struct("coef", "alpha", "gamma", "theta")),
        by_channel("mm_params", F.when(F.col("rsq").isNotNull(), fitted)),
        by_channel(
            "channel_decomp", F.struct("roi_total", "effect_share", "spend_share", "mean_carryover", "mean_spend_adstocked")
        ),
    )
    metrics = fits.join(won, KEYS, "left_semi").select(
        *KEYS, F.struct("rsq_train", "nrmse", "decomp_rssd", "mape").alias("fit_metrics")
    )
    record = metrics.join(maps, KEYS)
    if weekly is None:
        return record
    entry = F.struct(F.col("component").alias("key"), F.col("value").alias("value"))
    dates = weekly.join(won, KEYS, "left_semi").groupBy(*KEYS, "date").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("values"))
    by_date = lambda a, b: F.when(a["date"] < b["date"], -1).when(a["date"] > b["date"], 1).otherwise(0)
    series = dates.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("date", "values")), by_date).alias("weekly_decomp"))
    return record.join(series, KEYS)
