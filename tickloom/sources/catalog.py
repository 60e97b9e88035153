"""The asset catalog: CSV scan, or derivation from a declarative configuration."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import class_has_volume, periods_per_year

CSV_SCHEMA = (
    "symbol string, asset_class string, region string, name string, has_volume boolean, "
    "fx_pair string"
)
DEFAULT_REGION = "global"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and declared types; an empty ``fx_pair`` is NULL."""
    raw = spark.read.schema(CSV_SCHEMA).csv(path, header=True)
    return raw.withColumn("fx_pair", F.nullif(F.trim("fx_pair"), F.lit("")))


def derive_catalog(assets: DataFrame) -> DataFrame:
    """Fill defaults and add the columns that follow from the asset class."""
    columns = assets.columns
    region = F.coalesce(F.col("region"), F.lit(DEFAULT_REGION)) if "region" in columns else F.lit(
        DEFAULT_REGION
    )
    name = F.coalesce(F.col("name"), F.col("symbol")) if "name" in columns else F.col("symbol")
    fx_pair = F.col("fx_pair") if "fx_pair" in columns else F.lit(None).cast("string")
    return assets.select(
        "symbol",
        "asset_class",
        region.alias("region"),
        name.alias("name"),
        class_has_volume(F.col("asset_class")).alias("has_volume"),
        fx_pair.alias("fx_pair"),
        periods_per_year(F.col("asset_class")).alias("periods_per_year"),
    )


def catalog_from_config(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """Catalog rows from the ``assets`` list of a parsed configuration file."""
    fields = ("symbol", "asset_class", "region", "name", "fx_pair")
    rows = [tuple(asset.get(f) for f in fields) for asset in config["assets"]]
    schema = ", ".join(f"{f} string" for f in fields)
    return derive_catalog(spark.createDataFrame(rows, schema))


def restrict(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of configured assets only."""
    return df.join(catalog.select("symbol"), "symbol", "left_semi")
