"""Line items with their orders: odd keys, both ways of finding the channel, and reads of the large table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediamix.queries import model
from mediamix.queries.registered import QUERIES
from mediamix.sources import star

DATA = "/root/testdata/sf0.001"
HUGE = 1 << 62


@pytest.fixture
def odd(spark, tmp_path):
    """A few line items whose orders are negative, far apart, of other priorities or missing."""
    day = dt.datetime(2024, 3, 4)

    def write(name, rows):
        spark.createDataFrame(rows, star.SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))

    def write_orders(rows):
        spark.createDataFrame([(k, 1, "F", 10.0, day, p) for k, p in rows], star.SCHEMAS["orders"]).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))

    write("region", [(0, "ASIA")])
    write("nation", [(0, "CHINA", 0)])
    write("supplier", [(1, "s", 0, 0.0)])
    write("part", [(1, "p", "b", "TIN", 1, 9.0)])
    keys = [0, 15, 16, 127, 128, -1, -128, -129, HUGE, HUGE + 127, 7, None, 500]
    write("lineitem", [(k, 1, 1, 1, 1.0, 100.0 + i, 0.1, 0.5, "A", "O", day) for i, k in enumerate(keys)])
    priorities = [p for p, _, _ in star.CHANNELS]
    known = [(k, priorities[i % 5]) for i, k in enumerate(keys[:10])]
    write_orders([*known, (500, "6-NEVER"), (501, None), (None, "1-URGENT")])
    return str(tmp_path), write_orders, known


def spends(spark, d):
    row = star.panel_daily(spark, d).collect()[0]
    return row["sales_qty"], {ch: row[f"{ch}_impressions"] for _, _, ch in star.CHANNELS}, {ch: row[f"{ch}_spend"] for _, _, ch in star.CHANNELS}


def joined(spark, d):
    """The same from a plain join."""
    lines = star.table(spark, d, "lineitem").join(star.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    found = {r[0]: r for r in lines.groupBy("o_orderpriority").agg(F.sum("l_quantity"), F.sum(F.col("l_extendedprice") * F.col("l_tax"))).collect()}
    total = sum(r[1] for r in found.values())
    of = [{ch: found[p][i] if p in found else None for p, _, ch in star.CHANNELS} for i in (1, 2)]
    return total, *of


def test_odd_order_keys(spark, odd):
    d, _, _ = odd
    assert star.channel_lookup(star.table(spark, d, "orders")) is not None
    assert spends(spark, d) == joined(spark, d)


def test_repeated_order_keys_are_joined(spark, odd):
    d, write_orders, known = odd
    write_orders([*known, (16, "1-URGENT"), (500, None)])
    assert star.channel_lookup(star.table(spark, d, "orders")) is None
    assert spends(spark, d) == joined(spark, d)


def test_tables_too_large_are_joined(spark, monkeypatch):
    expected = sorted(map(str, star.panel_daily(spark, DATA).collect()))
    monkeypatch.setattr(star, "BROADCAST_BYTES", 0)
    assert star.channel_lookup(star.table(spark, DATA, "orders")) is None
    assert sorted(map(str, star.panel_daily(spark, DATA).collect())) == expected


@pytest.mark.parametrize("name", ["scan_panel", "time_features", "score_roas", "score_shares", "outlier_treatment", "impute_panel", "outlier_report"])
def test_line_items_are_read_once(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and plan.count("l_linestatus#") == 1  # the whole schema stands once for each read


def test_panel_of_the_search_reads_line_items_once(spark):
    plan = model.spoilt_panel(spark, DATA)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linestatus#") == 1


@pytest.mark.parametrize("name", ["response_tiers", "catalog_extend", "funnel_pairs", "resolve_weights"])
def test_supplier_catalogue_is_read_as_written(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_linestatus#" not in plan


@pytest.mark.parametrize("name", ["score_shares", "score_roas", "score_baseline", "fit_metrics"])
def test_line_items_meet_orders_and_parts_in_lookups(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    # written lookups, broadcast whatever the planner makes of the tables' size
    assert "l_orderkey#" in plan and "o_orderkey#" not in plan and "p_partkey#" not in plan
    assert plan.count("rightHint=(strategy=broadcast)") >= 2


def test_points_of_orders_meet_orders_and_parts_in_lookups(spark):
    plan = model.order_points(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey#" in plan and "o_orderkey#" not in plan and "p_partkey#" not in plan


def solutions(spark, d):
    """Channels of the solutions, and the same from a plain join."""
    ours = star.solution_channels(spark, d).select("sol_id", "channel", "effect", "spend", "mean_carryover")
    lines = star.table(spark, d, "lineitem").join(star.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(star.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    keys = F.concat(F.lit("s"), (F.col("l_orderkey") % 20).cast("string")).alias("sol_id"), F.col("o_orderpriority").alias("channel")
    plain = lines.groupBy(*keys).agg(F.sum("l_extendedprice"), F.sum("l_quantity"), F.avg("l_linenumber"))
    return [sorted((tuple(r) for r in df.collect()), key=str) for df in (ours, plain)]


ODD = [(500, "6-NEVER"), (7, None), (501, "unseen"), (None, "1-URGENT")]


@pytest.mark.parametrize(
    ("more", "looked_up"),
    [(ODD, True), ([*ODD, (502, "an eighth"), (503, "")], False), ([*ODD, (16, "5-LOW"), (500, None)], False)],
    ids=["other priorities", "more priorities than numbers", "repeated orders"],
)
@pytest.mark.parametrize("parts", [[1], [1, 1], [2], []], ids=["one", "twice", "missing", "none"])
def test_solutions_of_odd_orders_and_parts(spark, odd, tmp_path, more, looked_up, parts):
    d, write_orders, known = odd
    write_orders([*known, *more])
    spark.createDataFrame([(k, "p", "b", "TIN", 1, 9.0) for k in parts], star.SCHEMAS["part"]).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    ours, plain = solutions(spark, d)
    assert ours == plain and bool(ours) == (1 in parts)
    plan = star.solution_channels(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    assert ("o_orderkey#" not in plan) == looked_up
    assert ("p_partkey#" not in plan) == (len(parts) < 2)


def test_solutions_without_orders(spark, odd):
    d, write_orders, _ = odd
    write_orders([])
    assert solutions(spark, d) == [[], []]


def test_solutions_of_tables_too_large_are_joined(spark, monkeypatch):
    expected = sorted(map(str, star.solution_channels(spark, DATA).collect()))
    monkeypatch.setattr(star, "BROADCAST_BYTES", 0)
    large = star.solution_channels(spark, DATA)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey#" in plan and "p_partkey#" in plan
    assert sorted(map(str, large.collect())) == expected


def test_panel_of_many_parts_looks_them_up(spark, monkeypatch):
    expected = star.panel_daily(spark, DATA)
    rows = sorted(map(str, expected.collect()))
    monkeypatch.setattr(star, "PART_ROW", star.BROADCAST_BYTES)
    panel = star.panel_daily(spark, DATA)
    assert "p_partkey#" not in panel._jdf.queryExecution().optimizedPlan().toString()
    assert panel.dtypes == expected.dtypes and sorted(map(str, panel.collect())) == rows


@pytest.mark.parametrize("parts", [[(1, "TIN", 9.0), (130, None, 5.0)], [(1, None, None), (-7, "X", 1.0), (None, "X", 2.0)], [(1, "TIN", 9.0), (1, "X", 8.0)], [(1 + i, f"t{i}", 1.0 * i) for i in range(9)], [(2, "TIN", 1.0)]])
def test_odd_parts_of_the_panel(spark, odd, tmp_path, monkeypatch, parts):
    d, _, _ = odd
    spark.createDataFrame([(k, "p", "b", t, 1, v) for k, t, v in parts], star.SCHEMAS["part"]).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))

    def found():
        lines = star.with_parts(spark, d, star.table(spark, d, "lineitem").select("l_partkey"))
        return sorted((tuple(r) for r in lines.select("p_type", "p_retailprice").collect()), key=str)

    expected = sorted([(t, v) for k, t, v in parts if k == 1] * 13, key=str)
    assert found() == expected
    monkeypatch.setattr(star, "PART_ROW", star.BROADCAST_BYTES)
    assert found() == expected
