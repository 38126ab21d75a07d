"""The three stages from a catalogue file to written selections, as the README shows them."""

import csv

import pytest
from pyspark.sql import functions as F

from mediamix import Grain, load_catalog
from mediamix.modelling.features import media_long
from mediamix.operators.calendar import fill_calendar
from mediamix.operators.checks import raise_if_any
from mediamix.operators.aggregate import merge_metric_frames
from mediamix.plans import model, premodel, preprocess
from mediamix.session import checkpoint_dir, cut_lineage, is_local, release
from mediamix.sources import readers, sinks

GRAIN = Grain(("region", "brand"), "date")
CATALOG = [
    ("field_name", "description", "data_type", "data_category", "channel", "can_be_negative"),
    ("date", "day,\nas text", "date", "date", "x", "no"),
    ("region", "", "categorical", "grain", "x", "no"),
    ("brand", "", "categorical", "grain", "x", "no"),
    ("sales_revenue", "", "absolute", "sales", "x", "no"),
    ("price", "", "absolute", "price", "x", "no"),
    ("cpi", "", "rate", "macro", "x", "yes"),
    ("tv_spend", "", "absolute", "spend", "tv", "no"),
    ("tv_impressions", "", "absolute", "response", "tv", "no"),
    ("tv_clicks", "", "absolute", "response", "tv", "no"),
    ("tv_reach", "not in the data", "absolute", "response", "tv", "no"),
    ("radio_spend", "not in the data", "absolute", "spend", "radio", "no"),
    ("radio_grp", "not in the data", "absolute", "response", "radio", "no"),
    ("social_spend", "", "absolute", "spend", "social", "no"),
    ("social_impressions", "", "absolute", "response", "social", "no"),
]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("path")
    with open(folder / "catalogue.csv", "w", newline="", encoding="utf-8-sig") as file:
        csv.writer(file).writerows(CATALOG)
    noise, t = [F.rand(i) for i in range(6)], 20 + F.col("id") % 420
    rows = spark.range(2 * 420).select(
        F.date_format(F.date_add(F.lit("2021-01-04").cast("date"), (F.col("id") % 420).cast("int")), "dd-MM-yyyy").alias("Date"),
        F.when(F.col("id") < 420, "north").otherwise("south").alias("region"),
        F.lit("b").alias("brand"),
        (300 + 5 * (F.col("id") % 420) + 300 * noise[0] + 200 * noise[1]).alias("sales_revenue"),
        (10 + noise[2]).alias("price"),
        (100 + F.col("id") % 420 / 50).alias("cpi"),
        (t * noise[0]).alias("tv_spend"),
        (50 * t * noise[0] + 50 * noise[3]).alias("tv_impressions"),
        (0.4 * t * noise[0] + 5 * noise[4]).alias("tv_clicks"),
        (t * noise[1]).alias("social_spend"),
        (30 * t * noise[1] + 100 * noise[5]).alias("social_impressions"),
    )
    rows.coalesce(1).write.option("header", True).csv(str(folder / "panel"))
    catalog = load_catalog(spark, str(folder / "catalogue.csv"))
    raw = cut_lineage(readers.read_panel(spark, str(folder / "panel"), format="csv"))
    prepared = preprocess.preprocess(raw, catalog, GRAIN)
    ready = premodel.premodel(prepared.panel, prepared.registry, GRAIN)
    return folder, prepared, ready


def fields(registry):
    return {(r.role, r.channel, r.field_name) for r in registry.collect()}


def test_absent_metrics_take_no_part(stages):
    _, prepared, ready = stages
    found = fields(prepared.registry)
    assert {c for _, c, _ in found if c} == {"tv", "social"}
    assert {f for _, _, f in found} <= set(prepared.panel.columns)
    assert {r.field_name for r in prepared.catalog.collect()} <= {c for c in prepared.panel.columns} | {"date", "region", "brand"}
    assert {f for _, _, f in fields(ready.registry)} <= set(prepared.panel.columns)


def test_catalogue_round_trip_keeps_order(spark, stages):
    folder, prepared, _ = stages
    sinks.write_catalog(prepared.catalog, str(folder / "out_catalogue"))
    back = readers.read_processed_catalog(spark, str(folder / "out_catalogue"))
    wanted = [tuple(r) for r in prepared.catalog.orderBy("pos").collect()]
    assert [tuple(r) for r in back.select(prepared.catalog.columns).orderBy("pos").collect()] == wanted
    assert [r[prepared.catalog.columns.index("pos")] for r in wanted] == list(range(len(wanted)))
    assert any(r.is_derived for r in prepared.catalog.collect())


def test_registry_round_trip(spark, stages):
    folder, prepared, _ = stages
    sinks.write_registry(prepared.registry, str(folder / "registry"))
    assert fields(readers.read_registry(spark, str(folder / "registry"))) == fields(prepared.registry)


def test_selection_is_written_and_read(spark, stages):
    folder, _, ready = stages
    spec, media = premodel.model_spec(ready.registry)
    assert {c for c, _, _ in media} == {"tv", "social"}
    holidays = spark.createDataFrame([("2021-01-10",), ("2021-12-25",)], "d string").select(F.to_date("d").alias("date"))
    options = model.SearchOptions(trials=2, iterations=30, min_candidates=20)
    chosen = model.select_models(ready.panel, spec, media_long(ready.panel, media), holidays, options)
    sinks.write_selections(chosen.best, str(folder / "best"))
    sinks.write_params(chosen.params, str(folder / "params"))
    sinks.write_panel(ready.panel, str(folder / "ready"), by_segment=True)
    assert {r.segment for r in spark.read.json(str(folder / "best")).collect()} == {"north_b", "south_b"}
    params = spark.read.json(str(folder / "params")).collect()
    assert len(params) == 2 and all({"tv", "social"} == set(p.hill_params.asDict()) for p in params)
    assert spark.read.parquet(str(folder / "ready")).count() == ready.panel.count()
    assert chosen.scenarios.filter("at_limit IS NULL").count() == 0


def test_unique_is_checked(spark):
    rows = [("a", "b", "2024-01-01", 1.0), ("a", "b", "2024-01-01", 2.0), ("a", "b", "2024-01-03", 3.0)]
    df = spark.createDataFrame(rows, "region string, brand string, date string, sales_revenue double")
    columns = "pos long, field_name string, data_type string, data_category string, channel string, can_be_negative string"
    catalog = spark.createDataFrame([(0, "sales_revenue", "absolute", "sales", None, "no")], columns)
    with pytest.raises(ValueError, match="not unique"):
        preprocess.preprocess(df, catalog, GRAIN.as_unique())
    dated = df.withColumn("date", F.to_date("date"))
    filled = fill_calendar(dated, GRAIN.as_unique(), "daily")
    assert sorted(str(r.date) for r in filled.collect()) == ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"]


def _small_raw(spark, change=lambda i, row: row):
    rows = [change(i, ("a", "b", f"2024-01-{1 + i % 28:02d}", float(i % 7), float(i % 5), "Yes" if i % 2 else "no")) for i in range(28)]
    df = spark.createDataFrame(rows, "region string, brand string, date string, sales_revenue double, tv_spend double, promo_offer_flag string")
    columns = "pos long, field_name string, data_type string, data_category string, channel string, can_be_negative string"
    fields = [("sales_revenue", "absolute", "sales", None), ("tv_spend", "absolute", "spend", "tv"), ("promo_offer_flag", "flag", "promo", None)]
    return df, spark.createDataFrame([(n, *f, "no") for n, f in enumerate(fields)], columns)


@pytest.mark.parametrize("unique, passes", [(True, 2), (False, 3)])
def test_checks_cost_no_pass_over_the_raw_rows(spark, unique, passes):
    """Unique: the grain check and the panel. Else: quantiles, fills by date, and the panel."""
    read = spark.sparkContext.accumulator(0)
    raw, catalog = _small_raw(spark)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    preprocess.preprocess(raw.mapInArrow(counted, raw.schema), catalog, GRAIN.as_unique() if unique else GRAIN)
    assert read.value <= passes * raw.count()


def test_observed_checks_still_name_what_is_bad(spark):
    raw, catalog = _small_raw(spark, lambda i, r: (*r[:5], "perhaps") if i == 3 else r)
    with pytest.raises(ValueError, match="bad flag values.*perhaps"):
        preprocess.preprocess(raw, catalog, GRAIN)
    raw, catalog = _small_raw(spark, lambda i, r: (*r[:4], -1.0, r[5]) if i == 3 else r)
    with pytest.raises(ValueError, match="negative values.*tv_spend"):
        preprocess.preprocess(raw, catalog, GRAIN)


def test_merge_refuses_repeated_keys(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, a double")
    b = spark.createDataFrame([(1, 5.0)], "k int, b double")
    with pytest.raises(Exception, match="several rows on one of"):
        merge_metric_frames([a, b], ["k"]).collect()


def test_holidays_follow_the_week_label(spark):
    from mediamix.modelling.features import holidays_per_period

    sunday = spark.createDataFrame([("2024-03-03",)], "d string").select(F.to_date("d").alias("date"))
    labels = {label: str(holidays_per_period(sunday, "weekly", label).collect()[0].date) for label in ("iso_minus_1", "sunday_start")}
    assert labels == {"iso_minus_1": "2024-02-25", "sunday_start": "2024-03-03"}


def test_errors_tell_the_total_and_keep_all(spark):
    with pytest.raises(ValueError, match=r"bad: 50 cases, all in .*; the first: ") as error:
        raise_if_any(spark.range(50).withColumnRenamed("id", "n").filter("n >= 0").withColumn("c", F.lit(1)), "c", "bad")
    place = str(error.value).split("all in ")[1].split(";")[0]
    assert spark.read.parquet(place).count() == 50


def test_release_and_shared_folder(spark):
    table = cut_lineage(spark.range(5))
    assert table.count() == 5
    release(table)
    with pytest.raises(Exception):
        spark.read.parquet(table._cut_path).count()
    assert is_local("local[4]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session())
