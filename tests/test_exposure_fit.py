"""Half-saturation of the exposure curve: planted values, edges, channels without a curve."""

import math
import random

import pytest

from mediamix.modelling import exposure_fit

SCHEMA = "segment string, channel string, spend double, exposure double"


def fitted(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {(r["segment"], r["channel"]): r for r in exposure_fit.mm_fit(df).collect()}


def test_planted_half_saturations_are_found(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for n, ratio in enumerate([0.05, 0.3, 1.0, 4.0, 17.0, 30.0, 50.0, 300.0]):
        spends = [rng.random() * 10 for _ in range(120)] + [0.0, 0.0]
        km = ratio * sum(spends) / len(spends)
        want[(None if n == 3 else f"s{n}", "tv")] = km
        rows += [(None if n == 3 else f"s{n}", "tv", s, 500 * s / (km + s) if s else 0.0) for s in spends]
    got = fitted(spark, rows)
    assert got.keys() == want.keys()
    for key, km in want.items():
        r = got[key]
        assert r["km"] == pytest.approx(km, rel=1e-6) and r["vmax"] == pytest.approx(500, rel=1e-6)
        assert r["converged"] and r["km_edge"] is None and r["rsq_nls"] == pytest.approx(1)


def test_noisy_fit_is_the_best_there_is(spark):
    rng = random.Random(5)
    rows = [("s", "tv", s, 80 * s / (6 + s) + rng.gauss(0, 4)) for s in [rng.random() * 20 for _ in range(400)]]
    r = fitted(spark, rows)[("s", "tv")]

    def left(km):
        g = [s / (km + s) for _, _, s, _ in rows]
        a, b = sum(x * y for x, (*_, y) in zip(g, rows)), sum(x * x for x in g)
        return -a * a / b

    assert all(left(r["km"]) <= left(r["km"] * f) for f in (0.5, 0.9, 0.999, 1.001, 1.1, 2))
    slope = (left(r["km"] * (1 + 1e-4)) - left(r["km"] * (1 - 1e-4))) / abs(left(r["km"]))
    assert abs(slope) < 1e-9 and r["converged"]


def test_edges_and_channels_without_a_curve(spark):
    rows = [("s", "line", float(i), 3.0 * i) for i in range(1, 50)]
    rows += [("s", "flat", float(i), 7.0) for i in range(1, 50)]
    rows += [("s", "unspent", 0.0, 1.0), ("s", "unspent", None, 2.0), ("s", "unknown", None, None), ("s", "one", 2.0, 5.0)]
    got = fitted(spark, rows)
    assert got[("s", "line")]["km_edge"] == "high" and not got[("s", "line")]["converged"]
    assert got[("s", "line")]["km"] == pytest.approx(exposure_fit.HIGH * 25)
    assert got[("s", "flat")]["km_edge"] == "low"
    assert got[("s", "line")]["rsq_lm"] == pytest.approx(1)
    for channel in ("unspent", "unknown"):
        r = got[("s", channel)]
        assert r["km"] is None and r["vmax"] is None and r["km_edge"] is None and not r["converged"]
    df = spark.createDataFrame(rows, SCHEMA)
    flags = {r["channel"]: r for r in exposure_fit.mm_use_flag(exposure_fit.mm_fit(df)).collect()}
    assert flags["line"]["model_type"] == "lm" or flags["line"]["km_edge"] == "high"
    assert not flags["line"]["use_mm"] and not flags["unspent"]["use_mm"] and flags["unspent"]["model_type"] == "lm"
    assert math.isfinite(got[("s", "one")]["rsq_lm"] or 0)


def test_no_rows(spark):
    assert fitted(spark, []) == {}
