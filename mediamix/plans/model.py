"""Search, Pareto fronts, clusters, scores, best model and budget scenarios per segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.modelling import budget, cluster, decompose, exposure_fit, features, pareto, score, search
from mediamix.modelling.search import ModelSpec
from mediamix.session import cut_lineage, release


@dataclass(frozen=True)
class SearchOptions:
    trials: int = search.TRIALS
    iterations: int = search.ITERATIONS
    ridge: float = 0.01
    fronts: int = pareto.FRONTS
    min_candidates: int = pareto.MIN_CANDIDATES
    min_k: int = cluster.MIN_K
    max_k: int = cluster.MAX_K
    reach: float = budget.REACH
    frequency: str = "weekly"
    week_label: str = "iso_minus_1"


@dataclass(frozen=True)
class Selection:
    """What the modelling stage leaves behind, each frame keyed by segment.

    ``weekly`` and ``channels`` are those of the cluster winners. ``failures`` (segment,
    step, reason) names every segment of the panel that has no best model.
    """

    fits: DataFrame
    solutions: DataFrame
    weekly: DataFrame
    channels: DataFrame
    scores: DataFrame
    best: DataFrame
    params: DataFrame
    curves: DataFrame
    scenarios: DataFrame
    failures: DataFrame


def with_time_features(panel: DataFrame, holidays: DataFrame, spec: ModelSpec, options: SearchOptions = SearchOptions()) -> tuple[DataFrame, ModelSpec]:
    """Panel and specification with trend, season and holidays as context.

    Holidays may only add; the season, as a sine and a cosine, is free.
    """
    signs = {"trend": "default", "season_sin": "default", "season_cos": "default", "holiday": "positive"}
    timed = features.time_features(panel, holidays, frequency=options.frequency, week_label=options.week_label)
    return timed, replace(spec, context=(*spec.context, *signs.items()))


def candidate_params(solutions: DataFrame, channels: Sequence[str]) -> DataFrame:
    """(segment, sol_id, channel, theta, alpha, gamma) of chosen candidates."""
    entries = F.array(
        *[
            F.struct(
                F.lit(channel).alias("channel"),
                *[search.parameter(p, F.col("candidate"), i).alias(p) for p in search.BOUNDS],
            )
            for i, channel in enumerate(channels)
        ]
    )
    return solutions.select("segment", "sol_id", "candidate", F.inline(entries))


def parameter_columns(solutions: DataFrame, channels: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Solutions with one column per channel and hyper-parameter."""
    columns = {
        f"{p}_{i}": search.parameter(p, F.col("candidate"), i) for i in range(len(channels)) for p in search.BOUNDS
    }
    return solutions.withColumns(columns), list(columns)


def curve_params(params: DataFrame, channels: DataFrame) -> DataFrame:
    """What response curves need: mean spend, coefficient and half-saturation per channel."""
    levels = channels.select(*decompose.KEYS, "channel", "mean_spend", "coef", "low", "high")
    return params.join(levels, [*decompose.KEYS, "channel"]).withColumn(
        "half", F.col("low") + F.col("gamma") * (F.col("high") - F.col("low"))
    )


def _lost(before: DataFrame, after: DataFrame, step: str, reason: str) -> DataFrame:
    """(segment, step, reason) of the segments that a step left nothing of."""
    gone = before.select("segment").distinct().join(after.select("segment").distinct(), "segment", "left_anti")
    return gone.select("segment", F.lit(step).alias("step"), F.lit(reason).alias("reason"))


def select_models(
    panel: DataFrame,
    spec: ModelSpec,
    media: DataFrame,
    holidays: DataFrame | None = None,
    options: SearchOptions = SearchOptions(),
    exposures: Mapping[str, str] | None = None,
) -> Selection:
    """Search every segment at once and select a model for each.

    Each step writes its small result to the checkpoint folder, so a lost executor costs
    the step it interrupts.  ``media`` is the long (segment, date, channel, spend,
    exposure) panel; ``exposures`` names the exposure column of a channel in the winner's
    record.  A segment that a step fails for is left out of the later ones and listed in
    ``failures``; the others are not touched.
    """
    controls = [c for c, _ in spec.context]
    if holidays is not None:
        panel, spec = with_time_features(panel, holidays, spec, options)
    panel = cut_lineage(panel.filter(F.col("segment").isNotNull()))
    found = cut_lineage(search.search_report(panel, spec, options.trials, options.iterations, options.ridge))
    failed = found.filter(F.col("error").isNotNull()).groupBy("segment").agg(F.lit("search").alias("step"), F.min("error").alias("reason"))
    fits = found.filter(F.col("error").isNull()).drop("error").join(failed, "segment", "left_anti")
    front = cut_lineage(pareto.pareto_fronts(fits, options.fronts, options.min_candidates))
    failures = failed.unionByName(_lost(fits, front, "fronts", "no candidate has both criteria"))

    not_baseline = [*spec.channels, *controls]
    summaries = cut_lineage(decompose.decompose_solutions(panel, front, spec, not_baseline))
    measured = summaries.select(*decompose.KEYS, "rsq_train", "nrmse", "mape", "decomp_rssd")
    solutions = cut_lineage(front.drop("rsq_train", "nrmse", "decomp_rssd").join(measured, decompose.KEYS))

    columned, names = parameter_columns(solutions, spec.channels)
    clustered, unsettled = cluster.settled_clusters(columned, names, options.min_k, options.max_k)
    winners = cut_lineage(cluster.cluster_winners(clustered))
    reason = F.lit(f"clusters still move after {cluster.ROUNDS} rounds")
    failures = failures.unionByName(unsettled.select("segment", F.lit("clusters").alias("step"), reason.alias("reason")))
    top = solutions.join(winners, decompose.KEYS, "left_semi")
    top_summaries = summaries.join(winners, decompose.KEYS, "left_semi")
    channels = cut_lineage(decompose.channels_of(top_summaries))

    scores = cut_lineage(score.model_scores(score.measure_summaries(top_summaries)))
    best = cut_lineage(score.best_models(scores))
    failures = failures.unionByName(_lost(winners, best, "scores", "no solution has a score"))

    chosen = solutions.join(best, decompose.KEYS, "left_semi")
    params = candidate_params(chosen, spec.channels)
    used = exposure_fit.mm_use_flag(exposure_fit.mm_fit(media))
    weekly = cut_lineage(decompose.weekly_of(panel, top, spec))
    extracted = cut_lineage(score.winner_params(best, solutions, params, channels, used, weekly, exposures))
    curves = cut_lineage(budget.response_curves(curve_params(params, channels.join(best, decompose.KEYS, "left_semi")), reach=options.reach))
    failures = cut_lineage(failures)
    # what nothing that is returned still reads
    release(panel, front, summaries, clustered, winners)
    return Selection(
        fits=fits,
        solutions=solutions,
        weekly=weekly,
        channels=channels,
        scores=scores,
        best=best,
        params=extracted,
        curves=curves,
        scenarios=budget.budget_scenarios(curves),
        failures=failures,
    )
