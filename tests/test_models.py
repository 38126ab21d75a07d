"""Search, fronts, clusters and budgets on small planted data."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from mediamix.modelling import budget, cluster, pareto, score, search
from mediamix.modelling.search import ModelSpec


def test_carryover_equals_the_recursion(spark):
    series = [random.Random(1).random() for _ in range(37)]
    got = spark.range(1).select(search.adstock(F.array(*[F.lit(v) for v in series]), F.lit(0.7)).alias("a")).first()["a"]
    carried, want = 0.0, []
    for v in series:
        carried = v + 0.7 * carried
        want.append(carried)
    assert got == pytest.approx(want, rel=1e-12)
    single = spark.range(1).select(search.adstock(F.array(F.lit(2.0)), F.lit(0.5)).alias("a")).first()["a"]
    assert single == [2.0]


def test_planted_coefficients_are_found(spark):
    rng = random.Random(5)
    channels = ["tv", "web"]
    spec = ModelSpec("y", (("tv", "tv_spend"), ("web", "web_spend")), (("price", "negative"),))
    planted = 3
    params = [
        {p: search.BOUNDS[p][0] + (search.BOUNDS[p][1] - search.BOUNDS[p][0]) * (((planted + 1) * search._irrational(3 * i + j)) % 1) for j, p in enumerate(search.BOUNDS)}
        for i in range(2)
    ]
    weeks = 80
    spends = [[rng.uniform(0, 100) for _ in range(weeks)] for _ in channels]
    price = [rng.uniform(5, 10) for _ in range(weeks)]
    saturated = []
    for x, p in zip(spends, params):
        carried, now = [], 0.0
        for v in x:
            now = v + p["theta"] * now
            carried.append(now)
        half = min(carried) + p["gamma"] * (max(carried) - min(carried))
        saturated.append([a ** p["alpha"] / (a ** p["alpha"] + half ** p["alpha"]) for a in carried])
    y = [500 + 300 * a + 120 * b - 20 * c for a, b, c in zip(*saturated, price)]
    rows = [("s", dt.date(2020, 1, 5) + dt.timedelta(weeks=t), y[t], spends[0][t], spends[1][t], price[t]) for t in range(weeks)]
    panel = spark.createDataFrame(rows, "segment string, date date, y double, tv_spend double, web_spend double, price double")
    fits = search.search_candidates(panel, spec, trials=1, iterations=6, ridge=1e-9).orderBy(F.desc("rsq_train")).collect()
    best = fits[0]
    assert best["candidate"] == planted and best["sol_id"] == "1_4"
    assert best["coef"] == pytest.approx([300, 120, -20], rel=1e-3)
    assert best["rsq_train"] == pytest.approx(1.0, abs=1e-6) and best["intercept"] == pytest.approx(500, rel=1e-2)
    assert all(c >= 0 for r in fits for c in r["coef"][:2]) and all(r["coef"][2] <= 0 for r in fits)


def brute_fronts(points):
    rest, fronts = list(points), []
    while rest:
        top = [p for p in rest if not any(q[1] <= p[1] and q[2] <= p[2] and q[1:] != p[1:] for q in rest)]
        fronts.append({p[0] for p in top})
        rest = [p for p in rest if p not in top]
    return fronts


def test_fronts_equal_brute_force_with_ties(spark):
    rng = random.Random(2)
    points = [(str(i), float(rng.randint(0, 12)), float(rng.randint(0, 12))) for i in range(60)]
    df = spark.createDataFrame([("s", *p) for p in points], "segment string, sol_id string, nrmse double, decomp_rssd double")
    want = brute_fronts(points)
    assert {r["sol_id"] for r in pareto.front(df).collect()} == want[0]
    found = pareto.pareto_fronts(df, fronts=2, min_candidates=len(want[0]) + len(want[1]) + 1).collect()
    for i in (1, 2, 3):
        assert {r["sol_id"] for r in found if r["front"] == i} == want[i - 1]
    assert max(r["front"] for r in found) == 3


@pytest.mark.parametrize("block, merged, fronts, least", [(1 << 16, 64, 3, 0), (50, 2, 2, 40), (30, 3, 1, 10_000), (40, 2, 4, 1)])
def test_fronts_of_many_parts(spark, monkeypatch, block, merged, fronts, least):
    monkeypatch.setattr(pareto, "BLOCK", block)
    monkeypatch.setattr(pareto, "MERGED", merged)
    rng = random.Random(block)
    points = [(s, f"{s}{i}", rng.choice([rng.random(), rng.randint(0, 3) / 3]), rng.choice([rng.random() ** 4, 0.5])) for s, n in (("a", 300), (None, 30), ("b", 1), ("c", 12)) for i in range(n)]
    points += [("a", "nan", float("nan"), 0.0), ("a", "null", None, 0.0), ("d", "null", 0.0, None)]
    df = spark.createDataFrame(points, "segment string, sol_id string, nrmse double, decomp_rssd double").repartition(9)
    got = {(r["segment"], r["sol_id"]): r["front"] for r in pareto.pareto_fronts(df, fronts, least).collect()}
    want = {}
    for segment in ("a", None, "b", "c"):
        own = [(i, math.inf if x is not None and math.isnan(x) else x, y) for s, i, x, y in points if s == segment and x is not None and y is not None]
        taken = 0
        for number, front in enumerate(brute_fronts(own), 1):
            if number > fronts and taken >= least:
                break
            taken += len(front)
            want |= {(segment, i): number for i in front}
    assert got == want


def test_fronts_read_the_points_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(4000).selectExpr("'s' AS segment", "CAST(id AS STRING) AS sol_id", "rand(1) AS nrmse", "rand(2) AS decomp_rssd")
    found = pareto.pareto_fronts(df.mapInArrow(counted, df.schema))
    assert found.agg(F.max("front")).first()[0] >= 3 and found.count() >= 200
    assert reads.value == 4000


def test_clusters_of_two_segments_at_once(spark):
    rng = random.Random(4)
    rows = []
    for segment, centres in (("a", [0, 10, 20]), ("b", [0, 5, 50, 100])):
        for i in range(40):
            c = centres[i % len(centres)]
            rows.append((segment, f"{i:02d}", c + rng.random(), c + rng.random(), float(c) + i / 1000, rng.random(), rng.random()))
    df = spark.createDataFrame(rows, "segment string, sol_id string, x double, z double, nrmse double, decomp_rssd double, mape double")
    found = cluster.cluster_solutions(df, ["x", "z"], max_k=5, rounds=5)
    sizes = {(r["segment"], r["k"]): r["n"] for r in found.groupBy("segment", "k").agg(F.countDistinct("cluster").alias("n")).collect()}
    assert sizes[("a", 3)] == 3 and len(sizes) == 2
    winners = cluster.cluster_winners(found).filter("segment = 'a'").collect()
    assert len(winners) == 3 and sum(w["cluster_size"] for w in winners) == 40


def test_viability_falls_back(spark):
    rows = [("a", "1", -1.0, 0.9), ("a", "2", 1.0, 0.4), ("b", "1", -1.0, 0.9), ("b", "2", -2.0, 0.2), ("c", "1", 1.0, 0.9), ("c", "2", 1.0, 0.1)]
    df = spark.createDataFrame(rows, "segment string, sol_id string, baseline_min_weekly double, rsq_train double")
    viable = {(r["segment"], r["sol_id"]) for r in score.viability(df).filter("viable").collect()}
    assert viable == {("a", "2"), ("b", "1"), ("b", "2"), ("c", "1")}


def test_budget_bound_holds_and_is_nearly_reached(spark):
    rng = random.Random(6)
    params = [(seg, ch, rng.uniform(5, 20), rng.uniform(20, 200), rng.choice([0.6, 1.0, 1.7, 3.0]), rng.uniform(2, 15), rng.uniform(0, 0.6)) for seg in "ab" for ch in ("tv", "web", "sms")]
    df = spark.createDataFrame(params, "segment string, channel string, mean_spend double, coef double, alpha double, half double, theta double")
    curves = budget.response_curves(df, steps=8)
    envelopes, costs = {}, {}
    for r in budget.concave_steps(curves).orderBy("step").collect():
        envelopes.setdefault((r.segment, r.channel), []).append(r.gain if r.step else 0.0)
        costs[(r.segment, r.channel)] = 2 * r.mean_spend / 8
    rows = budget.budget_scenarios(curves).collect()
    for segment in "ab":
        own = [(costs[k], [sum(g[: n + 1]) for n in range(9)]) for k, g in envelopes.items() if k[0] == segment]
        total = sum(4 * cost for cost, _ in own)
        brute = max(
            sum(g[n] for (_, g), n in zip(own, choice))
            for choice in itertools.product(range(9), repeat=3)
            if sum(c * n for (c, _), n in zip(own, choice)) <= total + 1e-9
        )
        mine = [r for r in rows if r.segment == segment and r.scenario == "max_response"]
        response, (bound,) = sum(r.response for r in mine), {r.bound for r in mine}
        largest = max(b - a for _, g in own for a, b in zip(g, g[1:]))
        assert response <= brute + 1e-9 <= bound + 2e-9 and bound - response <= largest + 1e-9
        mine = [r for r in rows if r.segment == segment and r.scenario == "min_spend"]
        assert {r.bound for r in mine}.pop() <= sum(r.spend for r in mine) + 1e-9 <= {r.bound for r in mine}.pop() + max(c for c, _ in own) + 1e-6


def test_budget_is_spent_where_it_gains_most(spark):
    params = [("s", "good", 10.0, 100.0, 1.0, 5.0, 0.0), ("s", "poor", 10.0, 10.0, 1.0, 5.0, 0.0), ("s", "shaped", 10.0, 60.0, 3.0, 8.0, 0.0)]
    df = spark.createDataFrame(params, "segment string, channel string, mean_spend double, coef double, alpha double, half double, theta double")
    curves = budget.response_curves(df)
    gains = budget.concave_steps(curves).filter("step > 0").orderBy("channel", "step").collect()
    for a, b in zip(gains, gains[1:]):
        if a["channel"] == b["channel"]:
            assert b["gain"] <= a["gain"] + 1e-9
    got = budget.budget_scenarios(curves).groupBy("scenario").agg(F.sum("spend").alias("spend"), F.sum("response").alias("response"))
    totals = {r["scenario"]: r for r in got.collect()}
    now = curves.filter("abs(spend - mean_spend) < 1e-9").agg(F.sum("response").alias("r")).first()["r"]
    assert totals["max_response"]["spend"] <= 30 + 1e-6 and totals["max_response"]["response"] >= now - 1e-6
    assert totals["min_spend"]["spend"] <= 30 + 1e-6 and totals["min_spend"]["response"] >= now - 1e-6
    assert math.isfinite(now)
