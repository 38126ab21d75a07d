"""Which metrics become target, controls, exposures, spends and responses of the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.functions.scalars import contains_any
from mediamix.grain import tidy
from mediamix.operators.priorities import GLOBAL_RESPONSE, channel_keywords, keyword_place, keywords
from mediamix.operators.rules import ladder

# Caps and quality thresholds.
MAX_GLOBAL = 1
MAX_EXPOSURE = 2
MAX_RESPONSE = 4
MAX_SPEND = 2
MAX_NULL_SHARE = 0.30
MIN_STD = 1e-6
MIN_CV = 0.05
MIN_NONZERO_SHARE = 0.20
MIN_COVERAGE = 0.60

# Name parts that make a field a control, a rating point, or a response tier.
CONTROL_WORDS = ["gqv", "macro", "cpi", "inflation", "price", "promo_flag", "promo_offer_flag", "promo_perc"]
RATING_WORDS = ["grp", "trp"]
TIER_1_WORDS = ["order", "conversion", "install", "lead", "purchase", "sale"]
TIER_2_WORDS = ["click", "engage", "interaction", "pdp", "view"]
CONTROL_CATEGORIES = ["price", "promo", "macro"]
TIER_NAMES = {1: "raw_absolute", 2: "raw_engagement", 3: "derived", 4: "proxy_exposure"}


def metric_quality(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric, null_share, nonzero_share, mean, std, cv): all metrics in one aggregate."""
    wide = df.agg(
        *[
            c.alias(f"{name}_{m}")
            for m in metrics
            for name, c in {
                "null": F.try_divide(F.count_if(F.col(m).isNull()), F.count("*")),
                "nonzero": F.try_divide(F.count_if(F.col(m) != 0), F.count(m)),
                "mean": F.avg(F.col(m).cast("double")),
                "std": F.stddev_samp(F.col(m).cast("double")),
            }.items()
        ]
    )

    def stat(name: str, m: str) -> Column:
        return F.coalesce(F.col(f"{name}_{m}"), F.lit(0.0))

    return tidy(
        wide,
        [
            {
                "metric": F.lit(m),
                "null_share": stat("null", m),
                "nonzero_share": stat("nonzero", m),
                "mean": stat("mean", m),
                "std": stat("std", m),
                "cv": F.coalesce(F.try_divide(stat("std", m), stat("mean", m)), F.lit(0.0)),
            }
            for m in metrics
        ],
    )


def quality_filter(quality: DataFrame) -> DataFrame:
    """Quality with ``passes``, ``passes_as_exposure`` and the two warnings.

    Rating points need not vary to serve as an exposure.
    """
    solid = (F.col("null_share") <= MAX_NULL_SHARE) & (F.col("std") >= MIN_STD)
    varies = F.col("cv") >= MIN_CV
    return quality.withColumns(
        {
            "passes": solid & varies,
            "passes_as_exposure": solid & (varies | contains_any(F.col("metric"), RATING_WORDS)),
            "low_density": F.col("nonzero_share") < MIN_NONZERO_SHARE,
            "low_coverage": 1 - F.col("null_share") < MIN_COVERAGE,
        }
    )


def field_class() -> Column:
    name, kind = F.col("field_name"), F.col("data_type")
    return ladder(
        [
            (contains_any(name, CONTROL_WORDS), "control"),
            (F.col("data_category") == "spend", "spend"),
            (kind == "absolute", "exposure"),
            ((kind == "rate") & contains_any(name, RATING_WORDS), "exposure"),
        ],
        "response",
    )


def field_classes(catalog: DataFrame, absolute_conversions_as_response: bool = False) -> DataFrame:
    """Catalogue rows of real channels with the part they can play, ``field_class``.

    With ``absolute_conversions_as_response`` counts of orders, conversions and the like
    are responses instead of exposures.
    """
    found = field_class()
    if absolute_conversions_as_response:
        counted = (F.col("data_type") == "absolute") & contains_any(F.col("field_name"), TIER_1_WORDS)
        found = F.when((found == "exposure") & counted, "response").otherwise(found)
    return catalog.filter(F.col("channel").isNotNull()).withColumn("field_class", found)


def response_tier() -> Column:
    name, kind = F.col("field_name"), F.col("data_type")
    return ladder(
        [
            (F.col("is_derived"), 3),
            ((kind == "absolute") & contains_any(name, TIER_1_WORDS), 1),
            ((kind == "absolute") & contains_any(name, TIER_2_WORDS), 2),
        ],
        3,
    )


def keyword_rank(fields: DataFrame, role: str, longest: bool = False) -> DataFrame:
    """Rank of each field within its channel by the channel's keyword priorities.

    A channel's fields are columns of one table, so the window groups are small.
    """
    place = keyword_place(F.col("field_name"), channel_keywords(F.col("channel"), role, longest))
    order = Window.partitionBy("channel").orderBy("keyword_place", "pos")
    return fields.withColumn("keyword_place", place).withColumn("rank", F.row_number().over(order))


def _top(fields: DataFrame, role: str, count: int, longest: bool) -> DataFrame:
    return keyword_rank(fields, role, longest).filter(F.col("rank") <= count)


def _first_by_position(fields: DataFrame) -> DataFrame:
    """First field of each channel in catalogue order, with rank 1."""
    kept = [c for c in fields.columns if c != "channel"]
    return fields.groupBy("channel").agg(*[F.min_by(c, "pos").alias(c) for c in kept]).withColumn("rank", F.lit(1))


def _or_else(chosen: DataFrame, fallback: DataFrame) -> DataFrame:
    """``chosen``, with ``fallback`` for the channels it leaves empty."""
    open_channels = fallback.join(chosen.select("channel").distinct(), "channel", "left_anti")
    return chosen.unionByName(open_channels.select(chosen.columns))


def _with_quality(fields: DataFrame, quality: DataFrame) -> DataFrame:
    checked = quality_filter(quality).select(F.col("metric").alias("field_name"), "passes", "passes_as_exposure")
    return fields.join(checked, "field_name", "left").fillna(False, ["passes", "passes_as_exposure"])


def channel_candidates(
    catalog: DataFrame,
    quality: DataFrame,
    longest: bool = False,
    absolute_conversions_as_response: bool = False,
) -> DataFrame:
    """(role, channel, rank, field_name, tier) of every channel's candidates."""
    if "is_derived" not in catalog.columns:
        catalog = catalog.withColumn("is_derived", F.lit(False))
    fields = _with_quality(field_classes(catalog, absolute_conversions_as_response), quality)
    of_class = {c: fields.filter(F.col("field_class") == c) for c in ("spend", "exposure", "response")}
    shape = ["channel", "rank", "pos", "field_name"]

    first_spend = _first_by_position(of_class["spend"]).select(shape)
    exposure = _top(of_class["exposure"].filter("passes_as_exposure"), "exposure", MAX_EXPOSURE, longest)
    exposure = _or_else(exposure.select(shape), first_spend)

    by_position = Window.partitionBy("channel").orderBy("pos")
    spend = of_class["spend"].filter("passes").withColumn("rank", F.row_number().over(by_position))
    spend = _or_else(spend.filter(F.col("rank") <= MAX_SPEND).select(shape), first_spend)

    passing = of_class["response"].filter("passes").withColumn("tier", response_tier())
    best = passing.groupBy("channel").agg(F.min("tier").alias("tier"))
    kept = passing.join(best, ["channel", "tier"]).select("channel", "pos", "field_name", "tier")
    proxy = exposure.select("channel", F.col("rank").cast("long").alias("pos"), "field_name", F.lit(4).alias("tier"))
    response = _top(_or_else(kept, proxy), "response", MAX_RESPONSE, longest)

    no_tier = F.lit(None).cast("string")
    tier_name = ladder([(F.col("tier") == t, name) for t, name in TIER_NAMES.items()])
    parts = [
        exposure.select(F.lit("exposure").alias("role"), "channel", "rank", "field_name", no_tier.alias("tier")),
        response.select(F.lit("response").alias("role"), "channel", "rank", "field_name", tier_name.alias("tier")),
        spend.select(F.lit("spend").alias("role"), "channel", "rank", "field_name", no_tier.alias("tier")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def global_response(catalog: DataFrame, quality: DataFrame) -> DataFrame:
    """(rank, field_name): the best sales metric of sufficient quality."""
    words = F.array(*[F.lit(w) for w in keywords(GLOBAL_RESPONSE)])
    sales = _with_quality(catalog.filter(F.col("data_category") == "sales"), quality).filter("passes")
    best = sales.orderBy(keyword_place(F.col("field_name"), words), "pos").limit(MAX_GLOBAL)
    return best.select(F.lit(1).alias("rank"), "field_name")


def global_controls(catalog: DataFrame, quality: DataFrame) -> DataFrame:
    """(pos, field_name): price, promo and macro metrics of sufficient quality, else all."""
    controls = _with_quality(catalog.filter(F.col("data_category").isin(CONTROL_CATEGORIES)), quality)
    controls = controls.select(F.lit("control").alias("role"), "pos", "field_name", "passes")
    passing = controls.filter("passes")
    return (
        passing.unionByName(controls.join(passing.select("role").distinct(), "role", "left_anti"))
        .select("pos", "field_name")
    )


def candidate_registry(catalog: DataFrame, quality: DataFrame, **options) -> DataFrame:
    """Tidy registry: (role, channel, rank, field_name, tier) with the global roles first."""
    nothing = F.lit(None).cast("string")
    target = global_response(catalog, quality).select(
        F.lit("global_response").alias("role"), nothing.alias("channel"), "rank", "field_name", nothing.alias("tier")
    )
    controls = global_controls(catalog, quality).select(
        F.lit("global_control").alias("role"),
        nothing.alias("channel"),
        (F.col("pos") + 1).alias("rank"),
        "field_name",
        nothing.alias("tier"),
    )
    return target.unionByName(controls).unionByName(channel_candidates(catalog, quality, **options))


def require_channels(catalog: DataFrame) -> DataFrame:
    if catalog.filter(F.col("channel").isNotNull()).isEmpty():
        raise ValueError("the catalogue names no channel")
    return catalog


def nested_registry(registry: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """One row: global_response, global_controls and a map of channel to its candidates.

    With ``catalog`` its channels without any candidate are kept, with empty lists.

    Per channel at most two exposures, four responses and two spends are collected, per
    registry one entry per channel and control.
    """

    def ordered(role: str) -> Column:
        entries = F.collect_list(F.when(F.col("role") == role, F.struct("rank", "field_name")))
        return F.transform(F.array_sort(entries), lambda e: e["field_name"])

    named = registry.select("channel", "role", "rank", "field_name", "tier").filter(F.col("channel").isNotNull())
    if catalog is not None:
        nothing = [F.lit(None).cast(named.schema[c].dataType).alias(c) for c in ("role", "rank", "field_name", "tier")]
        named = named.unionByName(catalog.select("channel").filter(F.col("channel").isNotNull()).distinct().select("channel", *nothing))
    channels = (
        named.groupBy("channel")
        .agg(
            F.struct(
                ordered("exposure").alias("exposure"),
                ordered("response").alias("response"),
                ordered("spend").alias("spend"),
                F.coalesce(F.max("tier"), F.lit("none")).alias("response_tier"),
            ).alias("candidates")
        )
        .select(F.lit("channel").alias("role"), F.struct(F.col("channel").alias("key"), F.col("candidates").alias("value")).alias("entry"))
    )
    globals_ = registry.filter(F.col("channel").isNull()).agg(
        ordered("global_response").alias("global_response"), ordered("global_control").alias("global_controls")
    )
    mapped = channels.groupBy("role").agg(F.map_from_entries(F.array_sort(F.collect_list("entry"))).alias("channels"))
    return (
        globals_.withColumn("role", F.lit("channel")).join(mapped, "role", "left").select("global_response", "global_controls", "channels")
    )


def tidy_registry(nested: DataFrame) -> DataFrame:
    """Inverse of ``nested_registry``."""

    def listed(source: DataFrame, role: str, column: str, channel: Column, tier: Column) -> DataFrame:
        return source.select(
            F.lit(role).alias("role"), channel.alias("channel"), tier.alias("tier"), F.posexplode(column).alias("at", "field_name")
        ).select("role", "channel", (F.col("at") + 1).alias("rank"), "field_name", "tier")

    nothing = F.lit(None).cast("string")
    each = nested.select(F.explode("channels").alias("channel", "c"))
    parts = [
        listed(nested, "global_response", "global_response", nothing, nothing),
        listed(nested, "global_control", "global_controls", nothing, nothing),
        listed(each, "exposure", "c.exposure", F.col("channel"), nothing),
        listed(each, "response", "c.response", F.col("channel"), F.col("c.response_tier")),
        listed(each, "spend", "c.spend", F.col("channel"), nothing),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked
