"""Response of exposure to spend: Michaelis-Menten or a straight line through zero."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.functions.scalars import EPSILON
from mediamix.grain import join_on
from mediamix.session import cut_lineage, release

# Fixed values.
MAX_KM_RATIO = 10.0
MIN_RSQ = 0.95

# Half-saturations that are looked at, in mean spends; points and rounds of narrowing.
LOW, HIGH = 1e-3, 1e3
POINTS, ROUNDS = 24, 4


def _at(k: Column) -> dict[str, Column]:
    """Sums over rows at half-saturation ``k``: of y g, g g, and of both with g' for g."""
    u, y = F.col("u"), F.col("y")
    g = F.when(u != 0, u / (k + u)).otherwise(0.0)
    slope = F.when(u != 0, u / ((k + u) * (k + u))).otherwise(0.0)
    return {"yg": F.sum(y * g), "gg": F.sum(g * g), "ys": F.sum(y * slope), "gs": F.sum(g * slope)}


def _narrowed(rows: DataFrame, bounds: DataFrame, keys: list[str], first: bool) -> DataFrame:
    """(keys, low, high, rise, fall, edge): the points next to the best half-saturation.

    ``low`` and ``high`` are logarithms, ``rise`` and ``fall`` the sign-bearing derivative of the fit
    there, of different signs unless the best one lies at an edge. The first round starts
    from the best of all points; later ones follow the derivative, which tells points apart
    that fit equally well to all digits.
    """
    last = POINTS - 1
    step = (F.col("high") - F.col("low")) / last
    tried = join_on(rows, bounds.select(*keys, "low", step.alias("step")), keys).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(last))))
    summed = tried.groupBy(*keys, "low", "step", "i").agg(*(c.alias(name) for name, c in _at(F.exp(F.col("low") + F.col("step") * F.col("i"))).items()))
    gain = F.coalesce(F.try_divide(F.col("yg") * F.col("yg"), F.col("gg")), F.lit(-1.0))
    rising = F.col("yg") * F.col("gs") - F.col("ys") * F.col("gg")
    points = summed.select(*keys, "low", "step", F.struct("i", gain.alias("gain"), rising.alias("rise")).alias("point"))
    sorted_points = points.groupBy(*keys, "low", "step").agg(F.sort_array(F.collect_list("point")).alias("points"))
    found = cut_lineage(sorted_points.select(*keys, "low", "step", F.col("points.gain").alias("gain"), F.col("points.rise").alias("rising")))
    if first:
        best = F.array_position("gain", F.array_max("gain")).cast("int") - 1
        at = F.when(F.get("rising", best) > 0, best).otherwise(best - 1)
        edge = F.when(F.col("at") < 0, "low").when(F.col("at") >= last, "high")
    else:
        falls = F.array_position(F.transform(F.slice("rising", 2, last), lambda r: r <= 0), F.lit(True)).cast("int")
        at, edge = F.when(falls > 0, falls).otherwise(last) - 1, F.lit(None).cast("string")
    inside = F.least(F.greatest("at", F.lit(0)), F.lit(last - 1))
    found = found.withColumn("at", at).withColumns({"edge": edge, "inside": inside})
    return found.select(
        *keys,
        (F.col("low") + F.col("step") * F.col("inside")).alias("low"),
        (F.col("low") + F.col("step") * (F.col("inside") + 1)).alias("high"),
        F.get("rising", F.col("inside")).alias("rise"),
        F.get("rising", F.col("inside") + 1).alias("fall"),
        "edge",
    )


def mm_fit(media: DataFrame) -> DataFrame:
    """Fit per (segment, channel) of rows with spend and exposure.

    For a half-saturation ``km`` the best ``vmax`` has a closed form, so the fit is a search
    of one number: the best of ``POINTS`` half-saturations from ``LOW`` to ``HIGH`` mean
    spends, then rounds that narrow the step in which the derivative changes sign, and a
    last linear step. Every round is one map-side reduced aggregate for all segments and
    channels; nothing is fitted in a group. ``km_edge`` is low or high where the best ``km``
    is not inside the range; ``converged`` where it is and the derivative changes sign.

    Without any spend there is no curve (nulls), only the line. Rows without an exposure
    don't count for the curve; a null spend is none.
    """
    keys = ["segment", "channel"]
    totals = media.groupBy(*keys).agg(
        F.avg("spend").alias("mean_spend"),
        F.count("*").alias("n"),
        F.sum("exposure").alias("sy"),
        F.sum(F.col("exposure") * F.col("exposure")).alias("syy"),
        F.sum(F.col("spend") * F.col("exposure")).alias("sxy"),
        F.sum(F.col("spend") * F.col("spend")).alias("sxx"),
    )
    totals = cut_lineage(totals)
    u = F.coalesce(F.try_divide("spend", "mean_spend"), F.lit(0.0))
    rows = cut_lineage(join_on(media, totals.select(*keys, "mean_spend"), keys).select(*keys, u.alias("u"), F.col("exposure").alias("y")))
    bounds = totals.select(*keys, F.lit(math.log(LOW)).alias("low"), F.lit(math.log(HIGH)).alias("high"))
    edges = None
    for number in range(ROUNDS):
        bounds = _narrowed(rows, bounds, keys, number == 0)
        if edges is None:
            edges = bounds = cut_lineage(bounds)
    crossing = F.coalesce((F.col("rise") > 0) & (F.col("fall") <= 0), F.lit(False))
    within = F.when(crossing, F.col("rise") / (F.col("rise") - F.col("fall"))).otherwise(F.when(F.col("rise") > 0, 1.0).otherwise(0.0))
    found = bounds.select(*keys, F.exp(F.col("low") + (F.col("high") - F.col("low")) * within).alias("k"), crossing.alias("crossing"))
    found = join_on(found, edges.select(*keys, "edge"), keys)
    ends = F.when(F.col("edge") == "low", F.lit(LOW)).when(F.col("edge") == "high", F.lit(HIGH)).otherwise(F.col("k"))
    found = found.select(*keys, ends.alias("k"), "edge", (F.col("crossing") & F.col("edge").isNull()).alias("crossing"))
    sums = join_on(rows, found, keys).groupBy(*keys).agg(F.first("k").alias("k"), F.first("edge").alias("km_edge"), F.first("crossing").alias("converged"), *(c.alias(n) for n, c in _at(F.col("k")).items()))
    spent = F.col("gg") > 0
    slope = F.try_divide("sxy", "sxx")
    tss = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    vmax = F.try_divide("yg", "gg")
    fits = join_on(totals, sums, keys).select(
        *keys,
        "mean_spend",
        vmax.alias("vmax"),
        F.when(spent, F.col("k") * F.col("mean_spend")).alias("km"),
        (1 - F.try_divide(F.col("syy") - vmax * F.col("yg"), tss)).alias("rsq_nls"),
        slope.alias("coef_lm"),
        (1 - F.try_divide(F.col("syy") - slope * F.col("sxy"), tss)).alias("rsq_lm"),
        F.when(spent, F.col("km_edge")).alias("km_edge"),
        (spent & F.col("converged")).alias("converged"),
    )
    result = cut_lineage(fits)
    release(totals, rows, edges)
    return result


def mm_use_flag(fits: DataFrame) -> DataFrame:
    """Choose the model and whether the curve may be used.

    The curve counts only if it explains at least as much as the line; it is used if its
    half-saturation is within ten mean spends and it fits well.
    """
    curved = F.coalesce(F.col("rsq_nls") >= F.coalesce("rsq_lm", F.lit(float("-inf"))), F.lit(False))
    ratio = F.col("km") / (F.col("mean_spend") + EPSILON)
    return fits.select(
        "segment",
        "channel",
        F.when(curved, "nls").otherwise("lm").alias("model_type"),
        F.when(curved, F.col("vmax")).alias("vmax"),
        F.when(curved, F.col("km")).alias("km"),
        F.when(~curved, F.col("coef_lm")).alias("coef_lm"),
        F.when(curved, F.col("rsq_nls")).otherwise(F.col("rsq_lm")).alias("rsq"),
        F.when(curved, ratio).alias("km_ratio"),
        (curved & F.coalesce((ratio <= MAX_KM_RATIO) & (F.col("rsq_nls") >= MIN_RSQ), F.lit(False))).alias("use_mm"),
        F.when(curved, F.col("km_edge")).alias("km_edge"),
    )
