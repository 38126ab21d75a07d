"""Per-segment quantiles that stay exact without holding a segment in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.grain import Grain, join_measured, join_on
from mediamix.session import cut_lineage

# Fixed value: accuracy of the single-pass quantile, exact below half as many values.
ACCURACY = 1_000_000

# First pass over segments of any size: sketches of at most about this many samples.
SKETCH = 10_000
# Parts of about equally many distinct values that a bracket is cut into.
BUCKETS = 128


def quantile_column(name: str, index: int) -> str:
    return f"__q{index}_{name}"


def segment_quantiles(
    df: DataFrame,
    grain: Grain,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    sketch: int = SKETCH,
) -> DataFrame:
    """One row per segment with ``quantile_column(name, i)`` for every probability.

    A quantile is the value at rank ceil(p * n).  With a unique grain a segment has at
    most one value per calendar day and a single ``percentile_approx`` is exact.
    Otherwise segments larger than the sketch can hold are refined in a second pass.
    """
    if grain.unique:
        wide = df.groupBy(*grain.keys).agg(
            *[
                F.percentile_approx(value, list(probabilities), ACCURACY).alias(f"__all_{name}")
                for name, value in columns.items()
            ]
        )
        return wide.select(
            *grain.keys,
            *[
                F.col(f"__all_{name}")[i].alias(quantile_column(name, i))
                for name in columns
                for i in range(len(probabilities))
            ],
        )
    return _refined(df, grain, columns, probabilities, sketch)


def _bucketed(counted: DataFrame, target: Sequence[str]) -> DataFrame:
    """``counted`` with ``__bucket``: where ``__v`` lies between splitters of its target.

    Splitters are merged sketches of the values themselves, so buckets hold about equally
    many, however the values are spread; equal widths would put all but a few values of a
    heavy tail into one. What is below the bracket (no value) has bucket -1.
    """
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = counted.groupBy(*target).agg(F.percentile_approx("__v", shares, 8 * BUCKETS).alias("__cuts"))
    below = F.size(F.filter("__cuts", lambda c: c < F.col("__v")))
    return join_on(counted, cuts, target).withColumn("__bucket", F.when(F.col("__v").isNull(), -1).otherwise(below)).drop("__cuts")


def _refined(
    df: DataFrame,
    grain: Grain,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    sketch: int,
) -> DataFrame:
    """Sketch, then count.

    The result of pass 1, a row per segment, is written out and decides whether there is
    a pass 2 at all.  Pass 1 sketches every segment, which is exact up to ``sketch / 2`` values and else
    brackets each quantile between two values a few ranks-per-``sketch`` apart.  Pass 2
    counts the distinct values inside the brackets of the large segments (grouped by
    value, so spread over the cluster) and the rows below them, cuts each bracket into
    buckets of equally many of those, and finds the bucket and then the value that reaches
    the rank.
    """
    keys, margin = list(grain.keys), 2.0 / sketch
    asked = [p for q in probabilities for p in (max(q - margin, 0.0), q, min(q + margin, 1.0))]
    values = df.select(*keys, *[value.alias(f"__v_{name}") for name, value in columns.items()])
    sketched = values.groupBy(*keys).agg(
        *[
            c
            for name in columns
            for c in (
                F.count(f"__v_{name}").alias(f"__n_{name}"),
                F.percentile_approx(f"__v_{name}", asked, sketch).alias(f"__s_{name}"),
            )
        ]
    )
    first = cut_lineage(sketched)
    small = sketch // 2
    brackets = [
        F.struct(
            F.lit(name).alias("__name"),
            F.lit(i).alias("__i"),
            F.greatest(F.ceil(F.lit(float(q)) * F.col(f"__n_{name}")), F.lit(1)).alias("__rank"),
            # the outermost ranks have no bound on their outer side
            (F.lit(float("-inf")) if q - margin <= 0 else F.col(f"__s_{name}")[3 * i]).alias("__low"),
            (F.lit(float("inf")) if q + margin >= 1 else F.col(f"__s_{name}")[3 * i + 2]).alias("__high"),
            (F.col(f"__n_{name}") > small).alias("__large"),
        )
        for name in columns
        for i, q in enumerate(probabilities)
    ]
    bounds = first.select(*keys, F.filter(F.array(*brackets), lambda b: b["__large"]).alias("__bounds"))
    bounds = bounds.filter(F.size("__bounds") > 0)
    direct = first.select(
        *keys,
        *[
            F.col(f"__s_{name}")[3 * i + 1].alias(quantile_column(name, i))
            for name in columns
            for i in range(len(probabilities))
        ],
    )
    if bounds.isEmpty():
        return direct

    # one row per value and bracket it lies in or below; below only as a count
    tagged = join_measured(values, bounds, keys, row_bytes=80 * len(brackets))
    per_value = F.array(
        *[F.struct(F.lit(name).alias("__of"), F.col(f"__v_{name}").alias("__v")) for name in columns]
    )
    hits = (
        tagged.select(*keys, "__bounds", F.inline(per_value))
        .filter(F.col("__v").isNotNull())
        .select(
            *keys,
            "__v",
            F.inline(F.filter("__bounds", lambda b: (b["__name"] == F.col("__of")) & (F.col("__v") <= b["__high"]))),
        )
        .withColumn("__v", F.when(F.col("__v") >= F.col("__low"), F.col("__v")))
    )
    target = [*keys, "__name", "__i"]
    counted = hits.groupBy(*target, "__rank", "__v").agg(F.count("*").alias("__count"))
    placed = _bucketed(counted, target)
    buckets = placed.groupBy(*target, "__rank", "__bucket").agg(F.sum("__count").alias("__in"))
    upto = Window.partitionBy(*target).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = (
        buckets.withColumn("__upto", F.sum("__in").over(upto))
        .filter((F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__in") < F.col("__rank")))
        .select(*target, "__bucket", (F.col("__rank") - F.col("__upto") + F.col("__in")).alias("__left"))
    )
    inside = join_on(placed.select(*target, "__bucket", "__v", "__count"), chosen, [*target, "__bucket"])
    by_value = Window.partitionBy(*target).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        inside.withColumn("__upto", F.sum("__count").over(by_value))
        .filter(F.col("__upto") >= F.col("__left"))
        .groupBy(*target)
        .agg(F.min("__v").alias("__value"))
    )
    refined = found.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("__name") == name) & (F.col("__i") == i), F.col("__value"))).alias(f"__r{i}_{name}")
            for name in columns
            for i in range(len(probabilities))
        ]
    )
    done = join_on(join_on(direct, refined, keys, "left"), bounds.select(*keys, "__bounds"), keys, "left")

    def exact(name: str, i: int) -> Column:
        """What the second pass found; nothing there is an error where the sketch gave a bracket."""
        asked = F.exists("__bounds", lambda b: (b["__name"] == name) & (b["__i"] == i))
        rough = F.col(quantile_column(name, i))
        missing = F.coalesce(asked, F.lit(False)) & rough.isNotNull()
        lost = F.raise_error(F.lit(f"quantile {i} of {name}: no value at its rank")).cast("double")
        return F.coalesce(F.col(f"__r{i}_{name}"), F.when(missing, lost).otherwise(rough)).alias(quantile_column(name, i))

    return done.select(
        *keys,
        *[
            exact(name, i)
            for name in columns
            for i in range(len(probabilities))
        ],
    )
