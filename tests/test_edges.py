"""Edge cases on small frames, one per rule or known pitfall."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mediamix.catalog import Catalog, Metric, catalog_frame, check_catalog, read_catalog, normalize_catalog
from mediamix.functions.frequency import Frequency, parse_frequency, truncate
from mediamix.grain import Grain
from mediamix.operators import calendar, checks, conform, funnel, impute, outliers, priorities, quantiles, series, signals
from mediamix.operators.aggregate import aggregate_panel, merge_metric_frames
from mediamix.operators.rules import plan_catalog
from mediamix.sources import readers, sinks

UNIQUE = Grain(("k",), "date", unique=True)
LOOSE = Grain(("k",), "date", unique=False)


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def panel(spark, rows, schema="k string, date date, v double"):
    return spark.createDataFrame(rows, schema)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_frequency_names():
    assert parse_frequency(" Weekly ") is Frequency.WEEK
    assert parse_frequency("quarterly") is Frequency.QUARTER
    with pytest.raises(ValueError):
        parse_frequency("fortnightly")


def test_week_labels(spark):
    row = spark.range(1).select(
        truncate(F.lit(dt.date(2024, 1, 7)), Frequency.WEEK).alias("iso"),
        truncate(F.lit(dt.date(2024, 1, 7)), Frequency.WEEK, "sunday_start").alias("sunday"),
        truncate(F.lit(dt.date(2024, 1, 8)), Frequency.WEEK).alias("monday"),
    ).first()
    assert row["iso"] == dt.date(2023, 12, 31)
    assert row["sunday"] == row["monday"] == dt.date(2024, 1, 7)


def test_finer_grain_is_refused(spark):
    with pytest.raises(ValueError):
        calendar.convert_grain(panel(spark, [("a", day(0), 1.0)]), "date", "monthly", "daily")


def test_column_names_must_not_collide(spark):
    with pytest.raises(ValueError):
        calendar.normalize_columns(spark.range(1).select(F.lit(1).alias("A"), F.lit(2).alias(" a ")))


@pytest.mark.parametrize("grain", [UNIQUE, LOOSE])
def test_calendar_gaps_and_null_keys(spark, grain):
    df = panel(spark, [("a", day(0), 1.0), ("a", day(3), 2.0), (None, day(1), 5.0), (None, day(2), 6.0), ("b", None, 1.0)])
    got = sorted(values(calendar.fill_calendar(df, grain, "daily"), "k", "date", "v"), key=str)
    want = [("a", day(0), 1.0), ("a", day(1), None), ("a", day(2), None), ("a", day(3), 2.0), (None, day(1), 5.0), (None, day(2), 6.0)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("grain", [UNIQUE, LOOSE])
def test_month_steps_from_the_31st(spark, grain):
    dates = [dt.date(2024, 1, 31), dt.date(2024, 3, 31), dt.date(2024, 4, 15), dt.date(2024, 5, 31)]
    got = values(calendar.fill_calendar(panel(spark, [("a", d, 1.0) for d in dates]), grain, "monthly"), "date")
    assert sorted(d for (d,) in got) == [
        dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 30), dt.date(2024, 5, 31)
    ]


def test_duplicates_stay_in_the_calendar(spark):
    df = panel(spark, [("a", day(0), 1.0), ("a", day(0), 2.0), ("a", day(2), 3.0)])
    assert calendar.fill_calendar(df, LOOSE, "daily").count() == 4


@pytest.mark.parametrize("grain", [UNIQUE, LOOSE])
def test_fills_at_the_edges(spark, grain):
    df = panel(spark, [("a", day(i), v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])] + [("b", day(0), None)])
    filled = series.fill_series(
        df.withColumns({c: F.col("v") for c in "fnih"}),
        grain,
        {"f": (F.col("v"), "forward_fill"), "n": (F.col("v"), "nearest_known"), "i": (F.col("v"), "interpolate"), "h": (F.col("v"), "interpolate_hold")},
    ).filter("k = 'a'").orderBy("date")
    assert values(filled, "f", "n", "i", "h") == [
        (None, 1.0, None, 1.0), (1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 2.0, 2.0), (1.0, 1.0, 3.0, 3.0), (4.0, 4.0, 4.0, 4.0), (4.0, 4.0, None, 4.0)
    ]


@pytest.mark.parametrize("grain", [UNIQUE, LOOSE])
def test_trailing_mean_counts_from_one_row(spark, grain):
    df = panel(spark, [("a", day(i), v) for i, v in enumerate([1.0, 3.0, None, 8.0])])
    got = series.trailing_mean(df, grain, {"v": F.col("v")}).orderBy("date")
    assert [v for (v,) in values(got, "v")] == [1.0, 2.0, 2.0, 5.5]


def test_winsorize_keeps_nulls_unless_asked(spark):
    df = panel(spark, [("a", day(i), float(i)) for i in range(5)] + [("a", day(9), None)])
    kept = dict(values(outliers.winsorize(df, UNIQUE, ["v"]), "date", "v"))
    assert kept[day(9)] is None and kept[day(4)] == 4.0
    assert dict(values(outliers.winsorize(df, UNIQUE, ["v"], null_to_lower=True), "date", "v"))[day(9)] == 0.0


def test_zscore_of_constant_and_single_row_segments(spark):
    df = panel(spark, [("a", day(i), 2.0) for i in range(4)] + [("b", day(0), 7.0)])
    for grain in (UNIQUE, LOOSE):
        bounded = outliers.with_bounds(df, grain, (), ["v"])
        assert {m for (m,) in values(bounded.select(outliers.zscore_mask("v").alias("m")), "m")} == {False}


def test_outlier_takes_the_value_before_it(spark):
    rows = [("a", day(i), float(10 + i % 3)) for i in range(20)] + [("a", day(20), 1000.0)]
    for grain in (UNIQUE, LOOSE):
        got = dict(values(outliers.forward_fill_outliers(panel(spark, rows), grain, ["v"]), "date", "v"))
        assert got[day(20)] == got[day(19)] == 11.0
    with pytest.raises(ValueError):
        outliers.forward_fill_outliers(panel(spark, rows), UNIQUE, ["v"], "median")


def test_refined_quantiles_are_exact_for_a_hot_segment(spark):
    random.seed(3)
    rows = [("hot", random.choice([random.gauss(0, 100), 5.0])) for _ in range(3000)] + [("cold", float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, v double")
    probabilities = [0.01, 0.25, 0.5, 0.99]
    found = quantiles.segment_quantiles(df, LOOSE, {"v": F.col("v")}, probabilities, sketch=100)
    for row in found.collect():
        ordered = sorted(v for k, v in rows if k == row["k"])
        for i, p in enumerate(probabilities):
            rank = max(1, -int(-p * len(ordered) // 1))
            assert row[quantiles.quantile_column("v", i)] == ordered[rank - 1]


def test_quantiles_of_a_heavy_tail(spark):
    """Exact, and the last step looks at a part of the values that does not grow with the tail's width."""
    rng = random.Random(8)
    rows = [("hot", rng.paretovariate(0.3)) for _ in range(20_000)] + [("hot", float("inf"))] * 3 + [("b", 1.0)] * 90
    df = spark.createDataFrame(rows, "k string, v double")
    probabilities = [0.01, 0.5, 0.97, 0.999, 1.0]
    row = quantiles.segment_quantiles(df, LOOSE, {"v": F.col("v")}, probabilities, sketch=50).filter("k = 'hot'").first()
    ordered = sorted(v for k, v in rows if k == "hot")
    for i, p in enumerate(probabilities):
        assert row[quantiles.quantile_column("v", i)] == ordered[-int(-p * len(ordered) // 1) - 1]
    counted = df.filter("k = 'hot'").select("k", F.col("v").alias("__v")).groupBy("k", "__v").count()
    sizes = [r["count"] for r in quantiles._bucketed(counted, ["k"]).groupBy("__bucket").count().collect()]
    assert len(sizes) == quantiles.BUCKETS and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_channels_without_candidates_stay_in_the_registry(spark):
    registry = spark.createDataFrame([("exposure", "tv", 1, "tv_grp", None), ("global_response", None, 1, "sales", None)], "role string, channel string, rank int, field_name string, tier string")
    catalog = spark.createDataFrame([("tv",), ("radio",), (None,)], "channel string")
    found = signals.nested_registry(registry, catalog).first()
    assert found["global_response"] == ["sales"] and set(found["channels"]) == {"tv", "radio"}
    assert found["channels"]["tv"].exposure == ["tv_grp"]
    assert found["channels"]["radio"].asDict() == {"exposure": [], "response": [], "spend": [], "response_tier": "none"}
    assert set(signals.nested_registry(registry).first()["channels"]) == {"tv"}


def test_flags(spark):
    df = spark.createDataFrame([(" Yes ",), ("n",), (None,), ("maybe",)], "f string")
    assert [v for (v,) in values(checks.normalize_flags(df, ["f"]), "f")] == [1, 0, 0, 0]
    report = checks.flag_violations(df, ["f"])
    assert values(report, "column_name", "value", "n_rows") == [("f", "maybe", 1)]
    with pytest.raises(ValueError, match="maybe"):
        checks.raise_if_any(report, "n_rows", "bad flags")


def test_negativity_settings():
    assert checks.non_negative_metrics(Catalog((Metric("a", "absolute", "spend", None, "n"), Metric("b", "rate", "macro", None, "yes")))) == ["a"]
    for bad in (None, "maybe"):
        with pytest.raises(ValueError):
            checks.non_negative_metrics(Catalog((Metric("a", "absolute", "spend", None, bad),)))


def channel_plan(spark):
    rows = [("s", "Absolute", "Spend", "tv", "No"), ("r", "Absolute", "Response", "tv", "No"), ("p", "Percentage", "Response", "tv", "No")]
    return plan_catalog(catalog_frame(spark, rows), ["s", "r", "p"])


def test_spend_gap_with_response_fails_only_when_guarded(spark):
    plan = channel_plan(spark)
    df = spark.createDataFrame([("a", day(0), None, 3.0, None), ("a", day(1), 0.0, 1.0, None)], "k string, date date, s double, r double, p double")
    report = {(r["kind"], r["response"]): r["n_rows"] for r in checks.spend_response_conflicts(df, checks.spend_response_pairs(plan)).collect()}
    assert report == {("warning", "r"): 1, ("error", "r"): 1}
    with pytest.raises(Exception, match="was measured in a period without a figure"):
        impute.impute(df, UNIQUE, plan).collect()
    assert values(impute.impute(df, UNIQUE, plan, guard=False).orderBy("date"), "s", "r", "p") == [(0.0, 3.0, 0.0), (0.0, 1.0, 0.0)]


def test_weighted_mean_falls_back_and_counts_weights_of_null_values(spark):
    plan = Catalog((Metric("p", "rate", "response", "tv", "no", aggregate_rule="weighted_mean", weight="w"),))
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", None, 1.0), ("b", 1.0, 0.0), ("b", 2.0, 0.0)], "k string, p double, w double")
    assert dict(values(aggregate_panel(df, ["k"], plan), "k", "p")) == {"a": 0.75, "b": 1.5}
    with pytest.raises(ValueError):
        aggregate_panel(df, ["k", "missing"], plan)


def test_merge_matches_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert sorted(values(merge_metric_frames([a, b], ["k"]), "k", "a", "b"), key=str) == sorted([("x", 1, None), ("y", None, 4), (None, 2, 3)], key=str)


def test_catalogue_contract(spark):
    good = spark.createDataFrame([("A", "Absolute", "Spend", "TV", "No")], "field_name string, data_type string, data_category string, channel string, can_be_negative string")
    assert check_catalog(good).count() == 1
    for column, value in (("data_type", "odd"), ("data_category", "odd"), ("can_be_negative", "maybe"), ("channel", None)):
        with pytest.raises(ValueError):
            check_catalog(good.withColumn(column, F.lit(value).cast("string")))
    with pytest.raises(ValueError):
        check_catalog(good.drop("channel"))


def test_catalogue_file_with_bom_and_line_breaks(spark, tmp_path):
    path = tmp_path / "catalogue.csv"
    path.write_text('﻿field_name,description,data_type,data_category,channel,can_be_negative\nDate,"first\nsecond",Date,Date,x,No\nTV_Spend ,cost,Absolute,Spend,TV,No\n', encoding="utf-8")
    rows = normalize_catalog(read_catalog(spark, str(path))).orderBy("pos").collect()
    assert [(r["field_name"], r["channel"]) for r in rows] == [("date", None), ("tv_spend", "tv")]


def test_ratio_zero_and_null_denominators(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 2.0)], "n double, d double")
    assert [v for (v,) in values(funnel.add_ratios(df, [("q", "n", "d")]), "q")] == [2.0, 0.0, 0.0, None]


def test_names_lose_their_channel(spark):
    df = spark.createDataFrame(
        [("google_search_clicks", "Google Search"), ("clicks_google_search", "google search"), ("ads_tv_spend", "tv"), ("googlesearch_x", "google search"), ("tvs_spend", "tv")],
        "n string, c string",
    )
    assert [v for (v,) in values(df.select(funnel.clean_name(F.col("n"), F.col("c")).alias("v")), "v")] == ["clicks", "clicks", "ads_spend", "x", "tvs_spend"]


def test_priority_key_is_the_first_or_the_longest(spark):
    df = spark.createDataFrame([("DOOH",), ("CTV",), ("unknown",)], "c string")
    assert [v for (v,) in values(df.select(priorities.matching_key(F.col("c"), "exposure").alias("v")), "v")] == ["ooh", "tv", None]
    assert [v for (v,) in values(df.select(priorities.matching_key(F.col("c"), "exposure", longest=True).alias("v")), "v")] == ["dooh", "ctv", None]


def test_correlation_of_constants_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 3.0)], "y double, c double, n double")
    got = {r["field_name"]: r["corr"] for r in conform.exposure_correlations(df, [("a", "c"), ("a", "n"), ("a", "gone")], "y").collect()}
    assert got["c"] == 0.0 and "gone" not in got and 0 < got["n"] < 1


def test_segment_keys_with_nulls_stay_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert len(set(values(df.select(conform.segment_key(["x", "y", "z"]).alias("s")), "s"))) == 2


def test_signs():
    assert conform.check_signs(["a"], ["negative"]) == {"a": "negative"}
    for signs in ([], ["up"]):
        with pytest.raises(ValueError):
            conform.check_signs(["a"], signs)


def test_registry_document_round_trip(spark, tmp_path):
    rows = [("global_response", None, 1, "y", None), ("global_control", None, 1, "c", None), ("exposure", "tv", 1, "e", None), ("exposure", "tv", 2, "f", None), ("spend", "tv", 1, "s", None), ("response", "tv", 1, "r", "derived")]
    registry = spark.createDataFrame(rows, "role string, channel string, rank int, field_name string, tier string")
    sinks.write_registry(registry, str(tmp_path / "registry"))
    again = readers.read_registry(spark, str(tmp_path / "registry"))
    assert set(values(again, "role", "channel", "rank", "field_name", "tier")) == set(rows)


def test_panel_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("a", day(1), 2.5), ("b", day(0), None)], "segment string, date date, v double")
    sinks.write_panel(df, str(tmp_path / "p"), by_segment=True)
    assert set(values(readers.read_panel(spark, str(tmp_path / "p")), "segment", "date", "v")) == set(values(df, "segment", "date", "v"))
    plan = Catalog((Metric("v", "absolute", "spend"),))
    sinks.write_panel(df.withColumnRenamed("v", " V "), str(tmp_path / "c"), format="csv")
    back = calendar.parse_dates(readers.read_panel(spark, str(tmp_path / "c"), plan, format="csv"), "date")
    assert set(values(back, "segment", "date", "v")) == set(values(df, "segment", "date", "v"))
