"""Reading panels and registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamix.catalog import Catalog
from mediamix.operators.calendar import normalize_columns
from mediamix.operators.signals import tidy_registry

REGISTRY_SCHEMA = (
    "global_response array<string>, global_controls array<string>, "
    "channels map<string, struct<exposure: array<string>, response: array<string>, "
    "spend: array<string>, response_tier: string>>"
)


def csv_schema(header: Sequence[str], catalog: Catalog, text: Sequence[str] = ()) -> T.StructType:
    """Schema of a raw CSV panel: doubles for the catalogue's numbers, text for the rest.

    Dates stay text because they come in two notations, flags because they come as words.
    """
    numbers = set(catalog.fields(data_type=["absolute", "rate", "percentage"])) - set(text)
    return T.StructType(
        [T.StructField(c, T.DoubleType() if c.strip().lower() in numbers else T.StringType()) for c in header]
    )


def read_panel(spark: SparkSession, path: str, catalog: Catalog | None = None, format: str = "parquet") -> DataFrame:
    """Panel with normalised column names.

    A CSV panel is read with the catalogue's types, in one scan; without a catalogue its
    types are inferred, which costs a second scan.
    """
    if format == "csv":
        reader = spark.read.option("header", True)
        if catalog is None:
            return normalize_columns(reader.option("inferSchema", True).csv(path))
        header = reader.csv(path).columns
        return normalize_columns(reader.schema(csv_schema(header, catalog)).csv(path))
    return normalize_columns(spark.read.format(format).load(path))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Tidy registry from its JSON form."""
    nested = spark.read.schema(REGISTRY_SCHEMA).option("multiLine", True).json(path)
    return tidy_registry(nested)


def read_processed_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue as ``write_catalog`` wrote it, with its lineage columns."""
    schema = (
        "pos long, field_name string, data_type string, data_category string, can_be_negative string, "
        "channel string, is_derived boolean, derived_from string, funnel_role string"
    )
    found = spark.read.option("header", True).csv(path).columns
    kept = [f for f in T.StructType.fromDDL(schema).fields if f.name in found]
    ordered = T.StructType([next(f for f in kept if f.name == c) for c in found if c in {k.name for k in kept}])
    return spark.read.option("header", True).schema(ordered).csv(path).withColumn("channel", F.nullif("channel", F.lit("")))


#: Winner's record as ``sinks.write_params`` writes it; maps by channel, series by date.
PARAMS = (
    "segment string, sol_id string, fit_metrics struct<rsq_train:double,nrmse:double,decomp_rssd:double,mape:double>, "
    "hill_params map<string,struct<coef:double,alpha:double,gamma:double,theta:double>>, "
    "mm_params map<string,struct<model_type:string,vmax:double,km:double,coef_lm:double,rsq:double,exposure_col:string,km_ratio:double,use_mm:boolean,km_edge:string>>, "
    "channel_decomp map<string,struct<roi_total:double,effect_share:double,spend_share:double,mean_carryover:double,mean_spend_adstocked:double>>, "
    "weekly_decomp array<struct<date:date,values:map<string,double>>>"
)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Winners' records, one per segment."""
    return spark.read.schema(PARAMS).json(path)
