"""Solutions that are equal tie, whatever the order in which their rows arrive."""

from pyspark.sql import functions as F

from mediamix.modelling import cluster, decompose, score

CHANNELS = "segment string, sol_id string, channel string, effect double, spend double, roi_total double, mean_carryover double, mean_spend_adstocked double"


def decomposed(spark):
    """Two groups of equal solutions; the rows of each solution come in an order of its own."""
    channels, weekly = [], []
    for n in range(24):
        a = 0.1 + 0.7 * (n % 2)
        own = [("seg", f"s{n}", f"c{i}", a * 1.1**i, 0.3 * 1.3**i, a / (i + 3), 0.1 * 1.7**i, 0.2 * 1.7**i) for i in range(7)]
        turn = n % 7
        channels += own[turn:] + own[:turn] if n % 3 else (own[turn:] + own[:turn])[::-1]
        days = [(f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 10 + 0.1 * (i * i % 17), a * (i % 11) / 7) for i in range(60)]
        days = days[n:] + days[:n]
        weekly += [("seg", f"s{n}", d, c, v) for d, y, e in days for c, v in (("dep_var", y), ("depVarHat", y - e))]
    # many small parts, so that partial sums are merged as they arrive
    return (
        spark.createDataFrame(channels, CHANNELS).repartition(11),
        spark.createDataFrame(weekly, "segment string, sol_id string, date string, component string, value double").withColumn("date", F.to_date("date")).repartition(13),
    )


def test_equal_solutions_have_equal_measures(spark):
    channels, weekly = decomposed(spark)
    shared = decompose.with_shares(channels)
    fits = decompose.fit_metrics(weekly, shared)
    points = fits.join(score.channel_scores(shared), decompose.KEYS)
    names = ["nrmse", "mape", "decomp_rssd", "roas", "roas_cv", "carryover_pct", "max_share_delta"]
    assert points.select(*names).distinct().count() == 2
    clustered = cluster.cluster_solutions(points, ["roas", "roas_cv", "carryover_pct", "max_share_delta"])
    # the first id of each group by text, and every group whole
    found = sorted(tuple(r) for r in cluster.cluster_winners(clustered).select("sol_id", "cluster_size").collect())
    assert found == [("s0", 12), ("s1", 12)]


def test_equal_clusters_have_equal_silhouettes(spark):
    rows = [("seg", k, f"s{n}", n // 10, [0.1 * (n % 10) + 3.3 * (n // 10), 0.7 * (n % 7)]) for k in (3, 4, 5, 6) for n in range(40)]
    frame = spark.createDataFrame(rows, "segment string, k int, sol_id string, cluster int, v array<double>")
    for parts in (3, 7, 13):
        found = cluster.silhouettes(frame.repartition(parts), 2)
        assert found.select("silhouette").distinct().count() == 1
