"""Selection of many segments at once: decomposition in blocks, failing segments, the winner's record."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from mediamix.modelling import cluster, decompose, search
from mediamix.modelling.search import ModelSpec
from mediamix.plans import model
from mediamix.session import cut_lineage
from mediamix.sources import readers, sinks

SPEC = ModelSpec("y", (("tv", "tv_spend"), ("web", "web_spend")), (("price", "negative"),))
SCHEMA = "segment string, date date, y double, tv_spend double, web_spend double, price double"
WEEKS = 60


def rows_of(segment, seed, target=None, spend=None):
    rng = random.Random(seed)
    rows, carried = [], 0.0
    for t in range(WEEKS):
        tv, web, price = rng.random() * 100, rng.random() * 40, 5 + rng.random()
        carried = tv + 0.5 * carried
        y = 400 + 3 * carried / (1 + carried / 150) + 2 * web - 10 * price + rng.gauss(0, 5)
        rows.append((segment, dt.date(2021, 1, 3) + dt.timedelta(weeks=t), y if target is None else target(t, y), tv if spend is None else spend(t, tv), web, price))
    return rows


def long_media(panel):
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(s).alias("spend"), (F.col(s) * 7).alias("exposure")) for c, s in SPEC.media])
    return panel.select("segment", "date", F.inline(entries))


@pytest.fixture(scope="module")
def mixed(spark):
    """Good segments among such that fail in one way each."""
    rows = rows_of("good_a", 1) + rows_of("good_b", 2) + rows_of("constant", 3, lambda t, y: 9.0) + rows_of("null", 4, lambda t, y: None)
    rows += rows_of("infinite", 5, lambda t, y: math.inf if t == 7 else y) + rows_of("nan spend", 6, spend=lambda t, v: math.nan if t == 3 else v)
    panel = spark.createDataFrame(rows, SCHEMA)
    options = model.SearchOptions(trials=2, iterations=60, min_candidates=25)
    return panel, model.select_models(panel, SPEC, long_media(panel), options=options, exposures={"tv": "tv_reach"})


def test_failing_segments_are_reported_and_cost_the_others_nothing(spark, mixed):
    panel, chosen = mixed
    assert {r.segment for r in chosen.best.collect()} == {"good_a", "good_b"}
    assert {(r.segment, r.step, r.reason) for r in chosen.failures.collect()} == {
        ("constant", "search", "target does not vary"),
        ("null", "search", "no target value"),
        ("infinite", "search", "target is not finite"),
        ("nan spend", "search", "spend is not finite"),
    }
    alone = model.select_models(panel.filter("segment = 'good_a'"), SPEC, long_media(panel), options=model.SearchOptions(trials=2, iterations=60, min_candidates=25))
    assert [tuple(r) for r in alone.best.collect()] == [tuple(r) for r in chosen.best.filter("segment = 'good_a'").collect()]
    assert alone.failures.count() == 0


def test_fits_that_do_not_settle_are_one_segment_s_failure(spark, monkeypatch):
    monkeypatch.setattr(search, "SWEEPS", 1)
    panel = spark.createDataFrame(rows_of("a", 1), SCHEMA)
    with pytest.raises(Exception, match="still move after 1 sweeps"):
        search.search_candidates(panel, SPEC, 1, 3).collect()
    report = search.search_report(panel, SPEC, 1, 3).collect()
    assert report and all(r.candidate is None and "still move" in r.error for r in report)


def test_clusters_that_do_not_settle_are_set_apart(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("still", f"{i:03d}", float(i // 20) * 100, float(i % 7)) for i in range(60)]
    rows += [("moving", f"{i:03d}", rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "segment string, sol_id string, x double, nrmse double")
    monkeypatch.setattr(cluster, "LOOK", 2)
    clustered, unsettled = cluster.settled_clusters(df, ["x"], 3, 3, rounds=2)
    assert {r.segment for r in unsettled.collect()} == {"moving"}
    assert {r.segment for r in clustered.select("segment").distinct().collect()} == {"still"}
    with pytest.raises(ValueError, match="still move"):
        cluster.cluster_solutions(df, ["x"], 3, 3, rounds=2)


def test_block_decomposition_equals_that_of_weekly_rows(spark, monkeypatch):
    monkeypatch.setattr(decompose, "TOGETHER", 3)
    panel = cut_lineage(spark.createDataFrame(rows_of("a", 1) + rows_of("b", 2, lambda t, y: 0.0 if t == 5 else y), SCHEMA))
    solutions = cut_lineage(search.search_candidates(panel, SPEC, 1, 11))
    rows = decompose.solution_rows(panel, solutions, SPEC)
    weekly, channels = decompose.weekly_decomposition(rows, SPEC), decompose.channel_decomposition(decompose.media_rows(rows, SPEC))

    def table(df, *keys):
        return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}

    found = cut_lineage(decompose.decompose_solutions(panel, solutions, SPEC, ["tv", "web", "price"]))
    want, got = table(channels, "segment", "sol_id", "channel"), table(decompose.channels_of(found), "segment", "sol_id", "channel")
    assert want.keys() == got.keys() and len(want) == 44
    for key, row in want.items():
        for name in ("coef", "effect", "spend", "mean_carryover", "mean_spend_adstocked", "effect_share", "spend_share", "roi_total"):
            assert got[key][name] == pytest.approx(row[name], rel=1e-9, abs=1e-9), (key, name)
    metrics, summary = table(decompose.fit_metrics(weekly, channels), "segment", "sol_id"), table(found, "segment", "sol_id")
    from mediamix.modelling import score

    baseline = table(score.baseline_scores(weekly, ["tv", "web", "price"]), "segment", "sol_id")
    assert len(metrics) == 22
    for key in metrics:
        for name, value in {**metrics[key], **baseline[key]}.items():
            if name in summary[key] and name not in ("segment", "sol_id"):
                assert summary[key][name] == pytest.approx(value, rel=1e-9, abs=1e-9), (key, name)
    a, b = table(weekly, "segment", "sol_id", "date", "component"), table(decompose.weekly_of(panel, solutions, SPEC), "segment", "sol_id", "date", "component")
    assert a.keys() == b.keys()
    assert all(b[k]["value"] == pytest.approx(v["value"], rel=1e-9, abs=1e-9) for k, v in a.items())


def test_winner_record_round_trip(spark, mixed, tmp_path):
    _, chosen = mixed
    sinks.write_params(chosen.params, str(tmp_path / "params"))
    sinks.write_scores(chosen.scores, str(tmp_path / "scores"))
    sinks.write_weekly(chosen.weekly, str(tmp_path / "weekly"))
    back = {r.segment: r for r in readers.read_params(spark, str(tmp_path / "params")).collect()}
    assert back == {r.segment: r for r in chosen.params.select(*readers.read_params(spark, str(tmp_path / "params")).columns).collect()}
    for r in back.values():
        dates = [w.date for w in r.weekly_decomp]
        assert dates == sorted(dates) and len(dates) == WEEKS
        assert set(r.weekly_decomp[0]["values"]) == {"tv", "web", "price", "intercept", "dep_var", "depVarHat"}
        for w in r.weekly_decomp:
            parts = w["values"]
            assert parts["depVarHat"] == pytest.approx(sum(v for k, v in parts.items() if k not in ("dep_var", "depVarHat")))
        assert r.mm_params["tv"].exposure_col == "tv_reach" and r.mm_params["web"].exposure_col is None
    weekly = spark.read.parquet(str(tmp_path / "weekly"))
    assert weekly.count() == chosen.weekly.count() and spark.read.parquet(str(tmp_path / "scores")).count() == chosen.scores.count()
