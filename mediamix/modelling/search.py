"""Hyper-parameter candidates, carryover, saturation and the fit of every candidate.

Carryover and saturation follow Jin et al. 2017, "Bayesian Methods for Media Mix Modeling
with Carryover and Shape Effects".
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of the search and bounds of the hyper-parameters.
ITERATIONS = 2000
TRIALS = 5
BOUNDS = {"theta": (0.0, 0.8), "alpha": (0.5, 3.0), "gamma": (0.3, 1.0)}

# Candidates that share one shuffled copy of their segment's series.
BLOCKS_PER_TASK = 3


@dataclass(frozen=True)
class ModelSpec:
    """Columns of the model: target, media as (channel, spend column), context with signs."""

    target: str
    media: tuple[tuple[str, str], ...]
    context: tuple[tuple[str, str], ...] = ()

    @property
    def channels(self) -> list[str]:
        return [c for c, _ in self.media]

    @property
    def features(self) -> list[str]:
        return [*self.channels, *[c for c, _ in self.context]]


def _irrational(index: int) -> float:
    """Fractional part of the square root of the ``index``-th prime."""
    primes: list[int] = []
    n = 2
    while len(primes) <= index:
        if all(n % p for p in primes):
            primes.append(n)
        n += 1
    return math.sqrt(primes[index]) % 1


def spread(candidate: Column, index: int) -> Column:
    """Point of an additive quasi-random sequence in [0, 1): reproducible anywhere."""
    step = (candidate + 1) * F.lit(_irrational(index))
    return step - F.floor(step)


def parameter(name: str, candidate: Column, channel: int) -> Column:
    low, high = BOUNDS[name]
    place = list(BOUNDS).index(name)
    return low + (high - low) * spread(candidate, 3 * channel + place)


def solution_id(candidate: Column, iterations: int) -> Column:
    """``trial_iteration``, both counted from 1."""
    trial = F.floor(candidate / iterations).cast("int") + 1
    return F.concat_ws("_", trial.cast("string"), (F.pmod(candidate, F.lit(iterations)) + 1).cast("string"))


def candidate_grid(
    segments: DataFrame, channels: Sequence[str], trials: int = TRIALS, iterations: int = ITERATIONS
) -> DataFrame:
    """(segment, sol_id, candidate, channel, theta, alpha, gamma) for every segment."""
    candidates = segments.select("segment", F.explode(F.sequence(F.lit(0), F.lit(trials * iterations - 1))).alias("candidate"))
    entries = F.array(
        *[
            F.struct(
                F.lit(channel).alias("channel"),
                *[parameter(p, F.col("candidate"), i).alias(p) for p in BOUNDS],
            )
            for i, channel in enumerate(channels)
        ]
    )
    return candidates.select(
        "segment", solution_id(F.col("candidate"), iterations).alias("sol_id"), "candidate", F.inline(entries)
    )


def adstock(series: Column, theta: Column) -> Column:
    """Geometric carryover a[t] = x[t] + theta * a[t-1] over an array in date order.

    Computed by doubling: a round adds the value 1, 2, 4, ... places back, weighted by
    theta to that power, so the array is rebuilt log2(length) times and not once per
    entry.
    """
    rounds = F.greatest(F.ceil(F.log2(F.size(series).cast("double"))).cast("int"), F.lit(1))

    def add_shifted(state: Column, shift: Column) -> Column:
        reach = F.pow(F.lit(2.0), shift).cast("int")
        return F.struct(
            F.transform(
                state["carried"],
                lambda v, i: v + state["weight"] * F.coalesce(F.get(state["carried"], i - reach), F.lit(0.0)),
            ).alias("carried"),
            (state["weight"] * state["weight"]).alias("weight"),
        )

    start = F.struct(series.alias("carried"), theta.cast("double").alias("weight"))
    return F.aggregate(F.sequence(F.lit(0), rounds - 1), start, add_shifted, lambda state: state["carried"])


def adstock_long(media: DataFrame, grid: DataFrame) -> DataFrame:
    """Carryover of every channel's spend under every candidate, one row per date.

    A series has one entry per period of the calendar; periods must be gap-free.
    """
    series = media.groupBy("segment", "channel").agg(
        F.array_sort(F.collect_list(F.struct("date", "spend"))).alias("series")
    )
    carried = grid.join(series, ["segment", "channel"]).withColumn(
        "adstocked", adstock(F.transform("series", lambda e: e["spend"]), F.col("theta"))
    )
    points = F.transform(
        F.col("series"),
        lambda e, i: F.struct(
            e["date"].alias("date"), e["spend"].alias("spend"), F.get(F.col("adstocked"), i).alias("adstocked")
        ),
    )
    shape = [c for c in grid.columns]
    return carried.withColumns(
        {"low": F.array_min("adstocked"), "high": F.array_max("adstocked")}
    ).select(*shape, "low", "high", F.inline(points))


def hill(value: Column, alpha: Column, gamma: Column, low: Column, high: Column) -> Column:
    """Saturation x^a / (x^a + k^a) with k between the lowest and highest carryover."""
    half = low + gamma * (high - low)
    top = F.pow(value, alpha)
    return F.coalesce(F.try_divide(top, top + F.pow(half, alpha)), F.lit(0.0))


def segment_series(panel: DataFrame, spec: ModelSpec) -> DataFrame:
    """One row per segment with its target, context and spend arrays in date order.

    ``known`` counts the periods with a target; gaps are 0 in the arrays.
    The panel has one row per segment and period, so an array is as long as the calendar.
    """
    numbers = [spec.target, *[c for c, _ in spec.context], *[s for _, s in spec.media]]
    point = F.struct("date", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in dict.fromkeys(numbers)])
    return panel.groupBy("segment").agg(
        F.array_sort(F.collect_list(point)).alias("series"), F.count(F.col(spec.target)).cast("int").alias("known")
    )


def _arrays(spec: ModelSpec) -> dict[str, Column]:
    def picked(name: str) -> Column:
        return F.transform("series", lambda e: e[name])

    return {
        "date": F.transform("series", lambda e: e["date"]),
        "y": picked(spec.target),
        **{f"ctx_{i}": picked(c) for i, (c, _) in enumerate(spec.context)},
        **{f"spend_{i}": picked(s) for i, (_, s) in enumerate(spec.media)},
    }


def saturated_rows(candidates: DataFrame, spec: ModelSpec) -> DataFrame:
    """Period rows of candidates: date, y, ctx_j, spend_i, ad_i and the saturated x_i.

    ``candidates`` has the segment's arrays next to the candidate number; everything up
    to the period rows is computed within the row.
    """
    n, candidate = len(spec.media), F.col("candidate")
    ad = {f"ad_{i}": adstock(F.col(f"spend_{i}"), parameter("theta", candidate, i)) for i in range(n)}
    ranges = {
        f"{edge}_{i}": fn(f"ad_{i}") for i in range(n) for edge, fn in (("low", F.array_min), ("high", F.array_max))
    }
    kept = [c for c in candidates.columns if c not in _arrays(spec)]
    carried = candidates.withColumns(ad).withColumns(ranges)
    points = carried.select(*kept, *ranges, F.inline(F.arrays_zip(*_arrays(spec), *ad)))
    return points.withColumns(
        {
            f"x_{i}": hill(
                F.col(f"ad_{i}"),
                parameter("alpha", candidate, i),
                parameter("gamma", candidate, i),
                F.col(f"low_{i}"),
                F.col(f"high_{i}"),
            )
            for i in range(n)
        }
    ).drop(*ranges)


def candidate_blocks(panel: DataFrame, spec: ModelSpec, trials: int, iterations: int) -> DataFrame:
    """(segment, first, last, arrays): a segment's series once for each block of candidates.

    Blocks are spread over the tasks, so one segment is searched by many of them; with many
    segments a segment is one block.
    """
    total = trials * iterations
    # an explicit number keeps AQE from merging the few wide rows into one task
    tasks = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = panel.select("segment").distinct().count()
    block = max(1, -(-total // max(1, -(-BLOCKS_PER_TASK * tasks // max(1, segments)))))
    arrays = {n: c for n, c in _arrays(spec).items() if n != "date"}
    series = segment_series(panel, spec).select("segment", "known", *[c.alias(n) for n, c in arrays.items()])
    blocks = series.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((total - 1) // block))))
    first = (F.col("block") * block).cast("int")
    return blocks.repartition(tasks, "segment", "block").select(
        "segment", first.alias("first"), F.least(first + block, F.lit(total)).cast("int").alias("last"), "known", *arrays
    )


FITS = "segment string, candidate int, rsq_train double, nrmse double, decomp_rssd double, intercept double, coef array<double>, error string"
# Candidates whose series are in memory at a time, and that are solved at a time.
CHUNK, SOLVED = 64, 1024
# Sweeps after which a fit that still moves is an error.
SWEEPS = 100_000


def saturated_series(numbers: np.ndarray, spend: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Carryover and its saturation (candidates, media, periods) of the candidates ``numbers``.

    Also the least and the highest carryover of each. ``spend`` is (media, periods).
    """
    point = {name: np.outer(numbers + 1.0, [_irrational(3 * i + place) for i in range(len(spend))]) for place, name in enumerate(BOUNDS)}
    theta, alpha, gamma = (BOUNDS[p][0] + (BOUNDS[p][1] - BOUNDS[p][0]) * (point[p] - np.floor(point[p])) for p in BOUNDS)
    carried = np.empty((len(numbers), *spend.shape))
    before = np.zeros((len(numbers), len(spend)))
    for t in range(spend.shape[1]):
        before = spend[:, t] + theta * before
        carried[:, :, t] = before
    least, most = carried.min(2), carried.max(2)
    top = carried ** alpha[:, :, None]
    whole = top + ((least + gamma * (most - least)) ** alpha)[:, :, None]
    return carried, np.divide(top, whole, out=np.zeros_like(top), where=whole > 0), least, most


def _defect(known: int, y: np.ndarray, context: np.ndarray, spend: np.ndarray) -> str | None:
    """Why a segment cannot be modelled, if it cannot."""
    if not known:
        return "no target value"
    for name, values in (("target", y), ("context", context), ("spend", spend)):
        if not np.isfinite(values).all():
            return f"{name} is not finite"
    return "target does not vary" if y.min() == y.max() else None


def _fitter(spec: ModelSpec, ridge: float, report: bool):
    """Function from Arrow batches of ``candidate_blocks`` to batches of fits.

    With ``report`` a block that cannot be fitted becomes one row with its error.
    """
    n_media, n_context, chunk, solved, most_sweeps = len(spec.media), len(spec.context), CHUNK, SOLVED, SWEEPS
    signs = ["positive"] * n_media + [s for _, s in spec.context]
    low = np.array([0.0 if s == "positive" else -np.inf for s in signs])
    high = np.array([0.0 if s == "negative" else np.inf for s in signs])

    def bounded_ridge(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Coordinate descent for many small ridge problems at once, within the bounds.

        Those that no longer move are done; one that never stops is an error.
        """
        out = np.zeros_like(target)
        beta, open_ = out.copy(), np.arange(len(target))
        for _ in range(most_sweeps):
            before = beta.copy()
            for j in range(target.shape[1]):
                rest = target[:, j] - np.einsum("bk,bk->b", gram[:, j, :], beta) + gram[:, j, j] * beta[:, j]
                beta[:, j] = np.clip(rest / (gram[:, j, j] + ridge), low[j], high[j])
            still = np.abs(beta - before).max(1, initial=0.0) >= 1e-10
            if not still.all():
                out[open_[~still]] = beta[~still]
                beta, gram, target, open_ = beta[still], gram[still], target[still], open_[still]
                if not len(open_):
                    return out
        raise ValueError(f"{len(open_)} fits still move after {most_sweeps} sweeps")

    def shares(values: np.ndarray) -> np.ndarray:
        total = values.sum(1, keepdims=True)
        return np.divide(values, total, out=np.zeros_like(values), where=total != 0)

    def fits(segment: str, first: int, last: int, y: np.ndarray, context: np.ndarray, spend: np.ndarray) -> list[tuple]:
        numbers, periods, k = np.arange(first, last), len(y), n_media + n_context
        mean, cov, cross = np.empty((last - first, k)), np.empty((last - first, k, k)), np.empty((last - first, k))
        centred_y = y - y.mean()
        for at in range(0, last - first, chunk):
            x = saturated_series(numbers[at : at + chunk], spend)[1]
            x = np.concatenate([x, np.broadcast_to(context, (len(x), *context.shape))], axis=1)
            mean[at : at + chunk] = x.mean(2)
            x = x - x.mean(2, keepdims=True)
            cov[at : at + chunk] = x @ x.transpose(0, 2, 1) / periods
            cross[at : at + chunk] = x @ centred_y / periods
        var_y = float((centred_y**2).mean())
        std_y = np.sqrt(var_y) if var_y > 0 else 1.0
        std = np.sqrt(np.einsum("bkk->bk", cov))
        scale = np.where(std > 1e-12 * (1 + np.abs(mean)), std, np.inf)
        beta = bounded_ridge(cov / (scale[:, :, None] * scale[:, None, :]), cross / (scale * std_y))
        coef = beta * std_y / scale
        rss = np.maximum(var_y - 2 * (coef * cross).sum(1) + np.einsum("bj,bjk,bk->b", coef, cov, coef), 0.0) * periods
        tss, range_y = var_y * periods, float(y.max() - y.min())
        effect = shares(coef[:, :n_media] * mean[:, :n_media] * periods)
        spent = shares(np.broadcast_to(spend.sum(1), (1, n_media)).astype(float))
        distance = np.sqrt(((effect - spent) ** 2).sum(1))
        rsq = 1 - rss / tss if tss else np.zeros(len(rss))
        error = (np.sqrt(rss / periods) / range_y).tolist() if range_y else [None] * len(rss)
        intercept = y.mean() - (coef * mean).sum(1)
        return list(zip([segment] * len(rss), numbers.tolist(), rsq.tolist(), error, distance.tolist(), intercept.tolist(), coef.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["segment", "candidate", "rsq_train", "nrmse", "decomp_rssd", "intercept", "coef", "error"]
        types = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                y = np.array(row["y"], float)
                context = np.array([row[f"ctx_{i}"] for i in range(n_context)], float).reshape(n_context, len(y))
                spend = np.array([row[f"spend_{i}"] for i in range(n_media)], float).reshape(n_media, len(y))
                error = _defect(row["known"], y, context, spend) if report else None
                for at in range(row["first"], row["last"] if error is None else row["first"], solved):
                    try:
                        rows = fits(row["segment"], at, min(at + solved, row["last"]), y, context, spend)
                    except ValueError as failure:
                        if not report:
                            raise
                        error = str(failure)
                        break
                    yield batch_of([(*r, None) for r in rows])
                if error is not None:
                    yield batch_of([(row["segment"], *[None] * 6, error)])

    return run


def search_report(panel: DataFrame, spec: ModelSpec, trials: int = TRIALS, iterations: int = ITERATIONS, ridge: float = 0.01) -> DataFrame:
    """``search_candidates`` with ``error``: a segment that cannot be fitted has rows with that only.

    Such a segment has no value or no change in its target, a number that is not finite, or
    fits that do not settle. It costs the other segments nothing.
    """
    fits = candidate_blocks(panel, spec, trials, iterations).mapInArrow(_fitter(spec, ridge, True), FITS)
    return fits.withColumn("sol_id", solution_id(F.col("candidate"), iterations))


def search_candidates(
    panel: DataFrame,
    spec: ModelSpec,
    trials: int = TRIALS,
    iterations: int = ITERATIONS,
    ridge: float = 0.01,
) -> DataFrame:
    """(segment, candidate, rsq_train, nrmse, decomp_rssd, intercept, coef, sol_id).

    Sign-constrained ridge fits: media coefficients are not negative, context signs are the
    spec's. Every (segment, candidate) is generated, fitted and reduced to one row inside
    the task that holds its block; moments are taken about the mean, in numpy on bounded
    chunks, and weekly rows of candidates are never made.
    """
    fits = candidate_blocks(panel, spec, trials, iterations).mapInArrow(_fitter(spec, ridge, False), FITS)
    return fits.drop("error").withColumn("sol_id", solution_id(F.col("candidate"), iterations))
