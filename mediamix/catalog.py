"""The metric catalogue: loading, contract checks, and its plan-time form."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediamix.grain import require_columns, tidy

# Catalogue vocabulary.
REQUIRED = ["field_name", "data_type", "data_category", "channel", "can_be_negative"]
DATA_TYPES = ["absolute", "rate", "percentage", "flag", "binary", "date", "categorical"]
DATA_CATEGORIES = ["response", "spend", "macro", "grain", "date", "sales", "promo", "price"]
NO_CHANNEL = ["x", "na", "nan", '"na"', ""]
YES_NO = ["yes", "no", "y", "n"]
NOT_A_METRIC = ["date", "grain", "categorical"]


@dataclass(frozen=True)
class Metric:
    """One catalogue row together with the rules that apply to it."""

    field: str
    data_type: str
    category: str
    channel: str | None = None
    can_be_negative: str | None = None
    is_derived: bool = False
    outlier_rule: str | None = None
    fill_rule: str | None = None
    aggregate_rule: str | None = None
    weight: str | None = None
    funnel_role: str | None = None
    primary_exposure: bool = False


@dataclass(frozen=True)
class Catalog:
    """Catalogue as the planner sees it: one entry per column of the data."""

    metrics: tuple[Metric, ...] = field(default_factory=tuple)

    def __iter__(self):
        return iter(self.metrics)

    def __len__(self) -> int:
        return len(self.metrics)

    def where(self, **wanted) -> list[Metric]:
        """Metrics whose attributes equal, or lie in, the given values."""

        def keep(m: Metric) -> bool:
            return all(
                getattr(m, name) in v if isinstance(v, (list, tuple, set)) else getattr(m, name) == v
                for name, v in wanted.items()
            )

        return [m for m in self.metrics if keep(m)]

    def fields(self, **wanted) -> list[str]:
        return [m.field for m in self.where(**wanted)]


def channel_or_null(channel: Column) -> Column:
    """Lowercased channel; the spellings of "no channel" become null."""
    name = F.lower(F.trim(channel))
    return F.when(name.isin(NO_CHANNEL), F.lit(None)).otherwise(name)


def normalize_catalog(raw: DataFrame) -> DataFrame:
    """Trimmed, lowercased catalogue with a ``pos`` column giving the row order."""
    require_columns(raw, REQUIRED, "catalogue")
    if "pos" not in raw.columns:
        raw = raw.withColumn("pos", F.monotonically_increasing_id())
    plain = ["field_name", "data_type", "data_category", "can_be_negative"]
    return raw.select(
        "pos",
        *[F.lower(F.trim(F.col(c))).alias(c) for c in plain],
        channel_or_null(F.col("channel")).alias("channel"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV as written: all columns strings, quoted cells may span lines."""
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    return raw.toDF(*[c.lstrip("﻿").strip().lower() for c in raw.columns])


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    return normalize_catalog(check_catalog(read_catalog(spark, path)))


def contract_violations(raw: DataFrame) -> DataFrame:
    """(rule, column, n_bad) for every contract rule, from one aggregate."""
    require_columns(raw, REQUIRED, "catalogue")

    def outside(column: str, vocabulary: Sequence[str]) -> Column:
        return F.count_if(~F.lower(F.trim(F.col(column))).isin(list(vocabulary)))

    checks = [("null", c, F.count_if(F.col(c).isNull())) for c in REQUIRED]
    checks += [
        ("vocabulary", "data_type", outside("data_type", DATA_TYPES)),
        ("vocabulary", "data_category", outside("data_category", DATA_CATEGORIES)),
        ("vocabulary", "can_be_negative", outside("can_be_negative", YES_NO)),
    ]
    wide = raw.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(checks)])
    return tidy(
        wide,
        [
            {"rule": F.lit(rule), "column_name": F.lit(column), "n_bad": F.col(f"n{i}")}
            for i, (rule, column, _) in enumerate(checks)
        ],
    )


def check_catalog(raw: DataFrame) -> DataFrame:
    """Return ``raw`` if it keeps the contract, raise listing the broken rules if not."""
    broken = [tuple(r) for r in contract_violations(raw).filter("n_bad > 0").collect()]
    if broken:
        raise ValueError(f"catalogue contract broken (rule, column, rows): {broken}")
    return raw


def extend_catalog(catalog: DataFrame, derived: DataFrame) -> DataFrame:
    """Append derived metrics whose names are new, renumber; originals are not derived.

    ``derived`` holds field_name, channel, derived_from and funnel_role, plus pos.
    """
    lineage = {"derived_from": F.lit(None).cast("string")}
    if "funnel_role" not in catalog.columns:
        lineage["funnel_role"] = F.lit(None).cast("string")
    originals = catalog.withColumns({"is_derived": F.lit(False), **lineage})
    new = derived.join(catalog.select("field_name"), "field_name", "left_anti").withColumns(
        {
            "data_type": F.lit("rate"),
            "data_category": F.lit("response"),
            "can_be_negative": F.lit("no"),
            "is_derived": F.lit(True),
        }
    )
    both = originals.unionByName(new.select(originals.columns))
    # one row per metric of the catalogue; positions stay whole numbers that a file holds
    place = F.row_number().over(Window.orderBy("pos")) - 1
    return both.withColumn("pos", place.cast("bigint"))


def present_metrics(catalog: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The catalogue's rows that ``columns`` of the data carry."""
    return catalog.filter(F.col("field_name").isin(list(columns)))


def catalog_frame(spark: SparkSession, rows: Iterable[tuple[str, str, str, str | None, str]]) -> DataFrame:
    """Catalogue from (field, type, category, channel, can_be_negative) tuples, in order.

    Built as one literal, so reading it needs no Python worker.
    """
    columns = ["field_name", "data_type", "data_category", "channel", "can_be_negative"]
    text = json.dumps([{"pos": i, **dict(zip(columns, row))} for i, row in enumerate(rows)])
    schema = "array<struct<pos: bigint, " + ", ".join(f"{c}: string" for c in columns) + ">>"
    return normalize_catalog(spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), schema))))
