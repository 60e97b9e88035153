"""Typed bars per source, and the canonical series with one row per bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import number, source_rank

TYPED = ("open", "high", "low", "close", "volume", "adj_close")
FLAGS = ("is_zero_volume", "has_null_price", "high_lt_low")


#: Numbers and numeric texts both read as text.
PAYLOAD = "open string, high string, low string, close string, volume string, adjClose string"


def all_sources(raw: DataFrame) -> DataFrame:
    """Bronze payloads as typed rows with quality flags; a map, no shuffle.

    A payload is parsed once. Numbers and numeric strings read alike; a payload without the key, or
    with a text that is no finite number, gives NULL.
    """
    cells = {key: number(F.col(f"_p.{key}")) for key in ("open", "high", "low", "close", "volume")}
    missing = F.lit(False)
    for price in ("open", "high", "low", "close"):
        missing = missing | F.col(price).isNull()
    return (
        raw.select(
            "source",
            "symbol",
            "granularity",
            F.col("candle_ts").alias("ts"),
            F.from_json("payload", PAYLOAD).alias("_p"),
        )
        .select(
            "source", "symbol", "granularity", "ts",
            *[cell.alias(key) for key, cell in cells.items()],
            F.when(F.col("source") == "tiingo", number(F.col("_p.adjClose"))).alias("adj_close"),
        )
        .withColumn("is_zero_volume", F.coalesce(F.col("volume") == 0, F.lit(False)))
        .withColumn("has_null_price", missing)
        .withColumn("high_lt_low", F.coalesce(F.col("high") < F.col("low"), F.lit(False)))
    )


def canonical(typed: DataFrame) -> DataFrame:
    """One row per (symbol, granularity, ts): the source of best priority, then by name."""
    keys = ["symbol", "granularity", "ts"]
    rest = ["source", *TYPED, *FLAGS]
    best = F.min_by(F.struct(*rest), F.struct(source_rank(F.col("source")), F.col("source")))
    return (
        typed.groupBy(*keys)
        .agg(best.alias("_b"))
        .select("_b.source", *keys, *[f"_b.{c}" for c in (*TYPED, *FLAGS)])
    )
