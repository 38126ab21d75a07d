"""Weekly and channel decomposition, and fit metrics of solutions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mediamix.functions.scalars import EPSILON
from mediamix.grain import in_order, join_on
from mediamix.modelling.search import ModelSpec, _arrays, saturated_rows, saturated_series, segment_series

KEYS = ["segment", "sol_id"]
TARGET, FITTED = "dep_var", "depVarHat"


def solution_rows(panel: DataFrame, solutions: DataFrame, spec: ModelSpec) -> DataFrame:
    """Period rows of chosen solutions with their coefficients, recomputed from the panel."""
    series = segment_series(panel, spec).select("segment", *[c.alias(n) for n, c in _arrays(spec).items()])
    chosen = solutions.select("segment", "sol_id", "candidate", "intercept", "coef")
    return saturated_rows(chosen.join(series, "segment"), spec)


def weekly_decomposition(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """(segment, sol_id, date, component, value) with target and fit as components."""
    media = len(spec.media)
    parts = [(c, F.col("coef")[i] * F.col(f"x_{i}")) for i, c in enumerate(spec.channels)]
    parts += [(c, F.col("coef")[media + i] * F.col(f"ctx_{i}")) for i, (c, _) in enumerate(spec.context)]
    parts.append(("intercept", F.col("intercept")))
    fitted = sum((value for _, value in parts[1:]), parts[0][1])
    parts += [(TARGET, F.col("y")), (FITTED, fitted)]
    entries = F.array(*[F.struct(F.lit(n).alias("component"), v.alias("value")) for n, v in parts])
    return rows.select(*KEYS, "date", F.inline(entries))


def media_rows(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """(segment, sol_id, channel, coef, spend, adstocked, effect), one row per date."""
    entries = F.array(
        *[
            F.struct(
                F.lit(channel).alias("channel"),
                F.col("coef")[i].alias("coef"),
                F.col(f"spend_{i}").alias("spend"),
                F.col(f"ad_{i}").alias("adstocked"),
                (F.col("coef")[i] * F.col(f"x_{i}")).alias("effect"),
            )
            for i, channel in enumerate(spec.channels)
        ]
    )
    return rows.select(*KEYS, "date", F.inline(entries))


def share(value: str, total: str) -> Column:
    return F.coalesce(F.try_divide(value, total), F.lit(0.0))


def channel_decomposition(media: DataFrame) -> DataFrame:
    """Per (segment, sol_id, channel): coef, roi, shares, carryover and mean carried spend.

    ``mean_carryover`` is the part of the mean carried-over spend that earlier periods
    brought in.
    """
    channels = media.groupBy(*KEYS, "channel").agg(
        F.max("coef").alias("coef"),
        F.sum("effect").alias("effect"),
        F.sum("spend").alias("spend"),
        F.avg(F.col("adstocked") - F.col("spend")).alias("mean_carryover"),
        F.avg("adstocked").alias("mean_spend_adstocked"),
    )
    return with_shares(channels).withColumn("roi_total", F.coalesce(F.try_divide("effect", "spend"), F.lit(0.0)))


def with_shares(channels: DataFrame) -> DataFrame:
    """Add effect and spend shares within each solution; a solution has few channels, which are read once."""
    whole = Window.partitionBy(*KEYS).orderBy("channel").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        channels.withColumns({"__effect": F.sum("effect").over(whole), "__spend": F.sum("spend").over(whole)})
        .withColumns({"effect_share": share("effect", "__effect"), "spend_share": share("spend", "__spend")})
        .drop("__effect", "__spend")
    )


def share_distances(channels: DataFrame) -> DataFrame:
    """(segment, sol_id, decomp_rssd) from channel shares."""
    gap = F.col("effect_share") - F.col("spend_share")
    return in_order(channels, KEYS, ["channel"]).groupBy(*KEYS).agg(F.sqrt(F.sum(gap * gap)).alias("decomp_rssd"))


def fit_metrics(weekly: DataFrame, channels: DataFrame) -> DataFrame:
    """(segment, sol_id, rsq_train, nrmse, mape, decomp_rssd) from the decompositions.

    Solutions of equal decompositions have equal metrics to the last bit.
    """

    def component(name: str) -> Column:
        return F.sum(F.when(F.col("component") == name, F.col("value")))

    dates = (
        weekly.filter(F.col("component").isin(TARGET, FITTED))
        .groupBy(*KEYS, "date")
        .agg(component(TARGET).alias("y"), component(FITTED).alias("fitted"))
    )
    error = F.col("y") - F.col("fitted")
    sums = in_order(dates, KEYS, ["date"]).groupBy(*KEYS).agg(
        F.sum(error * error).alias("rss"),
        F.var_pop("y").alias("var_y"),
        F.count("*").alias("n"),
        (F.max("y") - F.min("y")).alias("range_y"),
        F.avg(F.abs(F.try_divide(error, F.col("y")))).alias("mape"),
    )
    metrics = sums.select(
        *KEYS,
        F.coalesce(1 - F.try_divide(F.col("rss") / F.col("n"), F.col("var_y")), F.lit(0.0)).alias("rsq_train"),
        F.try_divide(F.sqrt(F.col("rss") / F.col("n")), F.col("range_y")).alias("nrmse"),
        "mape",
    )
    return join_on(metrics, share_distances(channels), KEYS, "left")


# Solutions of a segment that share one copy of its series.
TOGETHER = 64

CHANNEL = (
    "channel string, coef double, effect double, spend double, mean_carryover double, mean_spend_adstocked double, "
    "effect_share double, spend_share double, roi_total double, mean_spend double, low double, high double"
)
SUMMARY = (
    "segment string, sol_id string, rsq_train double, nrmse double, mape double, decomp_rssd double, "
    f"baseline_min_weekly double, baseline_mean_weekly double, baseline_pct_mean double, channels array<struct<{CHANNEL.replace(' double', ':double').replace(' string', ':string')}>>"
)


def _solution_blocks(panel: DataFrame, solutions: DataFrame, spec: ModelSpec) -> DataFrame:
    """(segment, series arrays, solutions): a segment's series once for each block of its solutions."""
    sizes = solutions.groupBy("segment").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("blocks"))
    one = F.struct("candidate", "sol_id", "intercept", "coef")
    placed = join_on(solutions, sizes, ["segment"]).withColumn("block", F.pmod(F.xxhash64("candidate"), F.col("blocks")))
    blocks = placed.groupBy("segment", "block").agg(F.collect_list(one).alias("solutions"))
    series = segment_series(panel, spec).select("segment", *[c.alias(n) for n, c in _arrays(spec).items()])
    tasks = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return join_on(blocks, series, ["segment"]).repartition(tasks, "segment", "block")


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=np.asarray(b) != 0)


def _decomposed(row: dict, spec: ModelSpec) -> tuple[np.ndarray, ...]:
    """y, spend, carryover, its least and highest, and the parts (solutions, components, periods) of a block.

    Components are the channels, the context columns and the intercept.
    """
    chosen, media, context = row["solutions"], len(spec.media), len(spec.context)
    y = np.array(row["y"], float)
    spend = np.array([row[f"spend_{i}"] for i in range(media)], float).reshape(media, len(y))
    ctx = np.array([row[f"ctx_{i}"] for i in range(context)], float).reshape(context, len(y))
    carried, x, low, high = saturated_series(np.array([c["candidate"] for c in chosen]), spend)
    coef = np.array([c["coef"] for c in chosen], float)
    constant = np.broadcast_to(np.array([c["intercept"] for c in chosen], float)[:, None, None], (len(chosen), 1, len(y)))
    parts = np.concatenate([coef[:, :media, None] * x, coef[:, media:, None] * ctx, constant], axis=1)
    return y, spend, carried, low, high, coef, parts


def decompose_solutions(panel: DataFrame, solutions: DataFrame, spec: ModelSpec, not_baseline: Sequence[str]) -> DataFrame:
    """Fit metrics, baseline measures and channels of chosen solutions, a row each.

    ``solutions``: (segment, sol_id, candidate, intercept, coef). Everything is recomputed
    from the segment's series and reduced to one row in the task that holds the block, so
    no weekly rows are written or shuffled for solutions that are not selected. Components
    that are not in ``not_baseline`` make up the baseline.
    """
    schema = StructType.fromDDL(SUMMARY)
    arrow = to_arrow_schema(schema)
    names = [*spec.features, "intercept"]
    media, based = len(spec.media), np.array([c not in not_baseline for c in names])

    def rows(row: dict) -> list[dict]:
        y, spend, carried, low, high, coef, parts = _decomposed(row, spec)
        error = y - parts.sum(1)
        rss, var_y, range_y = (error**2).mean(1), float(y.var()), float(y.max() - y.min())
        known = y != 0
        effect, spent = parts[:, :media].sum(2), spend.sum(1)
        effect_share, spend_share = _divided(effect, effect.sum(1, keepdims=True)), _divided(spent, spent.sum())
        base = parts[:, based].sum(1)
        out = []
        for n, chosen in enumerate(row["solutions"]):
            channels = [
                {
                    "channel": channel,
                    "coef": coef[n, i],
                    "effect": effect[n, i],
                    "spend": spent[i],
                    "mean_carryover": (carried[n, i] - spend[i]).mean(),
                    "mean_spend_adstocked": carried[n, i].mean(),
                    "effect_share": effect_share[n, i],
                    "spend_share": spend_share[i],
                    "roi_total": effect[n, i] / spent[i] if spent[i] else 0.0,
                    "mean_spend": spend[i].mean(),
                    "low": low[n, i],
                    "high": high[n, i],
                }
                for i, channel in enumerate(spec.channels)
            ]
            out.append(
                {
                    "segment": row["segment"],
                    "sol_id": chosen["sol_id"],
                    "rsq_train": 1 - rss[n] / var_y if var_y else 0.0,
                    "nrmse": np.sqrt(rss[n]) / range_y if range_y else None,
                    "mape": np.abs(error[n][known] / y[known]).mean() if known.any() else None,
                    "decomp_rssd": np.sqrt(((effect_share[n] - spend_share) ** 2).sum()),
                    "baseline_min_weekly": base[n].min(),
                    "baseline_mean_weekly": base[n].mean(),
                    "baseline_pct_mean": (base[n] / (y + EPSILON)).mean(),
                    "channels": channels,
                }
            )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(rows(row), schema=arrow)

    return _solution_blocks(panel, solutions, spec).mapInArrow(run, schema)


def channels_of(summary: DataFrame) -> DataFrame:
    """(segment, sol_id, channel and its measures) of ``decompose_solutions``."""
    return summary.select(*KEYS, F.inline("channels"))


def weekly_of(panel: DataFrame, solutions: DataFrame, spec: ModelSpec) -> DataFrame:
    """``weekly_decomposition`` of chosen solutions, recomputed in blocks."""
    schema = StructType.fromDDL("segment string, sol_id string, date date, component string, value double")
    arrow = to_arrow_schema(schema)
    names = [*spec.features, "intercept", TARGET, FITTED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                y, *_, parts = _decomposed(row, spec)
                dates = pa.array(row["date"], pa.date32())
                for chosen, own in zip(row["solutions"], parts):
                    values = np.concatenate([own, y[None], own.sum(0)[None]])
                    n = len(names) * len(y)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(row["segment"], pa.string()), n),
                            pa.repeat(pa.scalar(chosen["sol_id"], pa.string()), n),
                            pa.concat_arrays([dates] * len(names)),
                            pa.array(np.repeat(names, len(y)).tolist(), pa.string()),
                            pa.array(values.reshape(-1), pa.float64()),
                        ],
                        schema=arrow,
                    )

    return _solution_blocks(panel, solutions, spec).mapInArrow(run, schema)
