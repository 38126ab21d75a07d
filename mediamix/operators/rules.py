"""Catalogue rules as DataFrame plans: which treatment applies to which metric.

All of them work on a catalogue of any size; the planner collects the annotated rows of
one table's own columns, nothing larger.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamix.catalog import Catalog, Metric

# Outlier rule of each metric category.
OUTLIER_RULES = {
    "spend": "winsorize",
    "sales": "winsorize",
    "promo": "winsorize",
    "response": "winsorize",
    "price": "forward_fill",
    "macro": "smooth",
}
NO_OUTLIER_TYPES = ["date", "categorical", "flag", "binary"]
FLAG_TYPES = ["flag", "binary"]
RATE_TYPES = ["rate", "percentage"]
SALES_CATEGORIES = ["sales", "sale", "revenue"]
MACRO_CATEGORIES = [
    "macro",
    "macro-economic",
    "macro economic",
    "macro-economic factors",
    "external factors",
    "external",
]

# Weight families in order of preference.
WEIGHT_FAMILIES = {
    "impression": "impression|impr|imp",
    "reach": "reach|unique_reach",
    "engagement": "engagement|engage|interaction",
    "click": "click|clk",
    "view": "view|video_view|vv|watch",
    "install": "install|app_install",
    "conversion": "conversion|conv|order|purchase",
    "spend": "spend|cost|expense",
}

# Funnel roles by name, first match wins.
FUNNEL_NAMES = {
    "exposure": "impression|reach|grp|trp|imp|spot|sent|deliver",
    "engagement": "click|view|visit|engage|clk|read",
    "conversion": "conversion|conv|order|install|purchase",
}
PRIMARY_EXPOSURE = ["impressions", "reach", "grp"]


def ladder(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """First matching case wins."""
    start, *rest = [(condition, F.lit(value)) for condition, value in cases]
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*start)).otherwise(F.lit(default))


def outlier_rule() -> Column:
    category, kind = F.col("data_category"), F.col("data_type")
    return ladder(
        [(kind.isin(NO_OUTLIER_TYPES), None)] + [(category == c, rule) for c, rule in OUTLIER_RULES.items()]
    )


def fill_rule() -> Column:
    """Imputation of a metric; where several apply the last in the treatment order wins.

    Every rule but the price and macro ones writes zeros, so an earlier zero fill
    leaves nothing for a later one and the order only matters to those two.
    """
    category, kind = F.col("data_category"), F.col("data_type")
    return ladder(
        [
            (category.isin(SALES_CATEGORIES), "zero"),
            (kind.isin(FLAG_TYPES), "zero"),
            (category == "price", "nearest_known"),
            (category.isin(MACRO_CATEGORIES), "interpolate"),
            ((category == "response") & (kind == "absolute"), "zero"),
            ((category == "spend") & (kind == "absolute"), "guarded_zero"),
            ((category == "response") & kind.isin(RATE_TYPES), "zero"),
        ],
        "leave",
    )


def aggregate_rule() -> Column:
    category, kind = F.col("data_category"), F.col("data_type")
    return ladder(
        [
            (kind == "absolute", "sum"),
            (kind.isin(RATE_TYPES) & (category == "response"), "weighted_mean"),
            (kind.isin(RATE_TYPES), "mean"),
            (kind.isin(FLAG_TYPES), "max"),
        ]
    )


def funnel_role() -> Column:
    category, kind, name = F.col("data_category"), F.col("data_type"), F.col("field_name")
    named = [
        ((category == "response") & name.rlike(f"(?i){pattern}"), role) for role, pattern in FUNNEL_NAMES.items()
    ]
    return ladder(
        [(category == "spend", "cost"), ((category == "response") & (kind == "rate"), "efficiency"), *named]
    )


def weight_family() -> Column:
    """Rank of the weight family a field name belongs to, first match wins."""
    return ladder(
        [(F.col("field_name").rlike(f"(?i){p}"), i) for i, p in enumerate(WEIGHT_FAMILIES.values())]
    )


def _first_by(field: Column, eligible: Column, *order: Column) -> Column:
    """Field of the first eligible row in the given order; null if there is none."""
    return F.min_by(field, F.when(eligible, F.struct(*order)))


def _weight() -> Column:
    eligible = (F.col("data_type") == "absolute") & weight_family().isNotNull()
    return _first_by(F.col("field_name"), eligible, weight_family().alias("family"), F.col("pos"))


def _primary_exposure() -> Column:
    preference = ladder(
        [(F.col("field_name").contains(word), i) for i, word in enumerate(PRIMARY_EXPOSURE)],
        len(PRIMARY_EXPOSURE),
    )
    eligible = (F.col("data_type") == "absolute") & (funnel_role() == "exposure")
    return _first_by(F.col("field_name"), eligible, preference.alias("preference"), F.col("pos"))


def _per_channel(catalog: DataFrame, **picks: Column) -> DataFrame:
    """Top-1 picks per channel, as aggregates with map-side combine, not windows."""
    named = [value.alias(name) for name, value in picks.items()]
    return catalog.filter(F.col("channel").isNotNull()).groupBy("channel").agg(*named)


def resolve_weights(catalog: DataFrame) -> DataFrame:
    """(field_name, channel, weight) for every response rate; null weight = plain mean.

    The weight is the channel's absolute column of the most preferred family.
    """
    rates = catalog.filter((F.col("data_category") == "response") & F.col("data_type").isin(RATE_TYPES))
    weights = _per_channel(catalog, weight=_weight())
    return rates.join(weights, "channel", "left").select("field_name", "channel", "weight")


def primary_exposures(catalog: DataFrame) -> DataFrame:
    """(channel, primary_exposure): the one exposure column ratios divide by."""
    return _per_channel(catalog, primary_exposure=_primary_exposure()).filter("primary_exposure IS NOT NULL")


def annotate(catalog: DataFrame) -> DataFrame:
    """Catalogue with the outlier, fill, aggregate and funnel rule of every metric."""
    if "is_derived" not in catalog.columns:
        catalog = catalog.withColumn("is_derived", F.lit(False))
    return (
        catalog.join(_per_channel(catalog, weight=_weight(), primary_exposure=_primary_exposure()), "channel", "left")
        .select(
            "pos",
            "field_name",
            "data_type",
            "data_category",
            "channel",
            "can_be_negative",
            "is_derived",
            outlier_rule().alias("outlier_rule"),
            fill_rule().alias("fill_rule"),
            aggregate_rule().alias("aggregate_rule"),
            F.when(aggregate_rule() == "weighted_mean", F.col("weight")).alias("weight"),
            funnel_role().alias("funnel_role"),
            F.coalesce(F.col("primary_exposure") == F.col("field_name"), F.lit(False)).alias("primary_exposure"),
        )
    )


def plan_catalog(catalog: DataFrame, columns: list[str]) -> Catalog:
    """Rules for the columns a table has; catalogue rows without a column are left out.

    One small job: at most one row per column of the table reaches the driver.
    """
    present = catalog.filter(F.col("field_name").isin(columns))
    rows = sorted(annotate(present).collect(), key=lambda r: r["pos"])
    return Catalog(
        tuple(
            Metric(
                field=r["field_name"],
                data_type=r["data_type"],
                category=r["data_category"],
                channel=r["channel"],
                can_be_negative=r["can_be_negative"],
                is_derived=r["is_derived"],
                outlier_rule=r["outlier_rule"],
                fill_rule=r["fill_rule"],
                aggregate_rule=r["aggregate_rule"],
                weight=r["weight"],
                funnel_role=r["funnel_role"],
                primary_exposure=r["primary_exposure"],
            )
            for r in rows
        )
    )
