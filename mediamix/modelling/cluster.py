"""Clusters of Pareto solutions by hyper-parameters, and the best solution of each.

K-means for all segments and all k at once: one job per round, whatever the number of
segments.  Centres travel as arrays on the solution rows, at most ``max_k`` per k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.grain import in_order, join_on
from mediamix.session import cut_lineage, release

# Fixed values.
MIN_K, MAX_K = 3, 10
WEIGHTS = (1.0, 1.0, 1.0)
# Rounds after which clusters that still move are an error, and rounds per look.
ROUNDS, LOOK = 300, 5


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda acc, v: acc + v)


def standardised(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``v``: the columns centred and scaled within the segment, constants as 0."""
    moments = in_order(points, ["segment"], ["sol_id"]).groupBy("segment").agg(
        *[e for c in columns for e in (F.avg(c).alias(f"__m_{c}"), F.stddev_pop(c).alias(f"__s_{c}"))]
    )
    scaled = [
        F.coalesce(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")), F.lit(0.0)) for c in columns
    ]
    return join_on(points, moments, ["segment"]).withColumn("v", F.array(*scaled)).select(*points.columns, "v")


def _seeds(points: DataFrame, min_k: int, max_k: int) -> DataFrame:
    """(segment, k, centres): k solutions evenly spaced along the NRMSE order.

    Segments with fewer solutions than k get no clustering for that k, unless they have
    fewer than ``min_k``, in which case each solution is a cluster.
    """
    order = Window.partitionBy("segment").orderBy("nrmse", "sol_id")
    ranked = points.withColumn("at", F.row_number().over(order) - 1)
    sizes = points.groupBy("segment").agg(F.count("*").alias("n"))
    wanted = (
        sizes.withColumn("k", F.explode(F.sequence(F.lit(min_k), F.lit(max_k))))
        .withColumn("k", F.when(F.col("k") == min_k, F.least("k", "n")).otherwise(F.col("k")))
        .filter(F.col("k") <= F.col("n"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), (F.col("k") - 1).cast("int"))))
        .withColumn("at", F.floor((F.col("j") + 0.5) * F.col("n") / F.col("k")).cast("int"))
    )
    return (
        wanted.join(ranked.select("segment", "at", "v"), ["segment", "at"])
        .groupBy("segment", "k")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "v"))), lambda e: e["v"]).alias("centres"))
    )


def _assign(points: DataFrame, centres: DataFrame) -> DataFrame:
    nearest = F.array_min(
        F.transform("centres", lambda c, i: F.struct(_distance(F.col("v"), c).alias("d"), i.alias("cluster")))
    )
    return points.join(centres, "segment").withColumn("cluster", nearest["cluster"])


def _close(a: Column, b: Column) -> Column:
    """Equal numbers of centres at equal places, but for rounding."""
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, _distance), lambda d: F.coalesce(d < 1e-18, F.lit(False)))


def _move(assigned: DataFrame, dimensions: int) -> DataFrame:
    means = assigned.groupBy("segment", "k", "cluster").agg(
        F.array(*[F.avg(F.col("v")[i]) for i in range(dimensions)]).alias("v")
    )
    return means.groupBy("segment", "k").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cluster", "v"))), lambda e: e["v"]).alias("centres")
    )


def silhouettes(assigned: DataFrame, dimensions: int) -> DataFrame:
    """(segment, k, silhouette) with squared distances, from per-cluster sums only.

    The same clusters have the same silhouette to the last bit, whatever k they come from.
    """
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    clusters = (
        in_order(assigned, ["segment", "k"], ["sol_id"])
        .groupBy("segment", "k", "cluster")
        .agg(
            F.count("*").alias("n"),
            F.avg(squares).alias("square"),
            F.array(*[F.avg(F.col("v")[i]) for i in range(dimensions)]).alias("mean"),
        )
        .groupBy("segment", "k")
        .agg(F.collect_list(F.struct("cluster", "n", "square", "mean")).alias("clusters"))
    )

    def mean_distance(c: Column) -> Column:
        dot = F.aggregate(F.zip_with("v", c["mean"], lambda p, q: p * q), F.lit(0.0), lambda acc, x: acc + x)
        return F.greatest(F.col("square") + c["square"] - 2 * dot, F.lit(0.0))

    rows = assigned.select("segment", "k", "sol_id", "cluster", "v", squares.alias("square")).join(clusters, ["segment", "k"])
    own = F.get(F.filter("clusters", lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    others = F.array_min(
        F.transform(F.filter("clusters", lambda c: c["cluster"] != F.col("cluster")), mean_distance)
    )
    rows = rows.withColumns({"own_n": own["n"], "other": others, "inner": mean_distance(own)})
    inner = F.try_divide(F.col("inner") * F.col("own_n"), F.col("own_n") - 1)
    value = F.when(F.col("own_n") > 1, F.coalesce(F.try_divide(F.col("other") - inner, F.greatest("other", inner)), F.lit(0.0)))
    valued = rows.select("segment", "k", "sol_id", F.coalesce(value, F.lit(0.0)).alias("value"))
    return in_order(valued, ["segment", "k"], ["sol_id"]).groupBy("segment", "k").agg(F.avg("value").alias("silhouette"))


def settled_clusters(
    points: DataFrame, columns: Sequence[str], min_k: int = MIN_K, max_k: int = MAX_K, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """Points with ``cluster`` and ``k``, and the (segment) whose centres never settled.

    k is that of the best silhouette of each segment. Centres move until none does any
    more, for ``rounds`` rounds at most; segments that still move then are set apart, with
    all their k. A cluster that loses its last point is gone, so a segment may end with
    fewer than k.
    """
    vectors = cut_lineage(standardised(points, columns))
    open_ = cut_lineage(_seeds(vectors, min_k, max_k))
    settled = cut_lineage(open_.limit(0))
    for _ in range(-(-rounds // LOOK)):
        centres = open_
        for _ in range(LOOK - 1):
            centres = _move(_assign(vectors, centres), len(columns))
        last = cut_lineage(centres)
        centres = _move(_assign(vectors, last), len(columns))
        both = cut_lineage(centres.join(last.withColumnRenamed("centres", "before"), ["segment", "k"]))
        still = ~_close(F.col("centres"), F.col("before"))
        done, moved = both.filter(~still).select("segment", "k", "centres"), both.filter(still).select("segment", "k", "centres")
        merged, left = cut_lineage(settled.unionByName(done)), cut_lineage(moved)
        release(both, last, settled, open_)
        settled, open_ = merged, left
        if open_.isEmpty():
            break
    unsettled = open_.select("segment").distinct()
    centres = settled.join(unsettled, "segment", "left_anti")
    assigned = cut_lineage(_assign(vectors, centres).drop("centres"))
    best = silhouettes(assigned, len(columns)).groupBy("segment").agg(
        F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k")
    )
    clustered = cut_lineage(assigned.join(best, ["segment", "k"]).drop("v"))
    release(vectors, settled, assigned)
    return clustered, unsettled


def cluster_solutions(
    points: DataFrame, columns: Sequence[str], min_k: int = MIN_K, max_k: int = MAX_K, rounds: int = ROUNDS
) -> DataFrame:
    """``settled_clusters`` of segments that must all settle."""
    clustered, unsettled = settled_clusters(points, columns, min_k, max_k, rounds)
    if not unsettled.isEmpty():
        raise ValueError(f"clusters still move after {rounds} rounds")
    return clustered


def balanced_error(criteria: Sequence[str], weights: Sequence[float] = WEIGHTS) -> Column:
    """Distance from the origin of the criteria, each scaled to its segment's range."""
    terms = [
        w * F.pow(F.coalesce(F.try_divide(F.col(c) - F.col(f"__low_{c}"), F.col(f"__high_{c}") - F.col(f"__low_{c}")), F.lit(0.0)), 2)
        for c, w in zip(criteria, weights)
    ]
    return F.sqrt(sum(terms[1:], terms[0]))


def cluster_winners(
    clustered: DataFrame, criteria: Sequence[str] = ("nrmse", "decomp_rssd", "mape"), weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """Best solution of each (segment, cluster): smallest weighted balanced error."""
    ranges = clustered.groupBy("segment").agg(
        *[e for c in criteria for e in (F.min(c).alias(f"__low_{c}"), F.max(c).alias(f"__high_{c}"))]
    )
    scored = join_on(clustered, ranges, ["segment"]).withColumn("balanced_error", balanced_error(criteria, weights))
    order = F.struct("balanced_error", "sol_id")
    return scored.groupBy("segment", "cluster").agg(
        F.min_by("sol_id", order).alias("sol_id"), F.min("balanced_error").alias("balanced_error"), F.count("*").alias("cluster_size")
    )
