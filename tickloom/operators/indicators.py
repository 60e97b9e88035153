"""Indicator table over canonical bars: moving averages, Cutler RSI, Bollinger bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.series import (
    CHUNK_BARS,
    by_chunk,
    chunk_order,
    number_bars,
    spread,
    tiled,
    tiles,
    trailing,
)

BAR_COLUMNS = ("symbol", "ts", "open", "high", "low", "close", "volume")
LONGEST_FRAME = 200


def price_changes(df: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Previous close, return, and the split of the change into gain and loss.

    ``greatest`` skips NULL, so the first bar (no previous close) needs its own guard.
    """
    w = chunk_order(keys)
    prev = F.col("prev_close")
    change = F.col("close") - prev
    return (
        df.withColumn("prev_close", F.lag("close").over(w))
        .withColumn("daily_return", F.col("close") / F.nullif(prev, F.lit(0.0)) - 1)
        .withColumn("gain", F.when(prev.isNotNull(), F.greatest(change, F.lit(0.0))))
        .withColumn("loss", F.when(prev.isNotNull(), F.greatest(-change, F.lit(0.0))))
    )


def indicators(bars: DataFrame, *, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """One row per (symbol, ts). A metric is NULL until its window has that many BARS.

    The gate counts bars, not non-null values: a window with some NULL volumes still averages
    the values it has.
    """
    numbered = number_bars(bars.select(*BAR_COLUMNS), chunk_bars=chunk_bars)
    w = chunk_order()
    rows = price_changes(by_chunk(spread(numbered, LONGEST_FRAME, chunk_bars=chunk_bars)))

    def from_bar(bar_number: int, value: Column) -> Column:
        return F.when(F.col("rn") >= bar_number - 1, value)

    def mean(column: str, size: int) -> Column:
        return F.avg(column).over(trailing(w, size))

    def long_mean(name: str, size: int) -> Column:
        return tiled(name, w, size, "sum") / F.nullif(tiled(name, w, size, "count"), F.lit(0))

    rows = rows.withColumns(
        {**tiles("c50", "close", w, 50, "sum"), **tiles("c200", "close", w, 200, "sum")}
    )
    up, down = F.col("_up"), F.col("_down")
    mid, dev = F.col("_mid"), F.col("_dev")
    return (
        rows.withColumn("_mid", mean("close", 20))
        .withColumn("_dev", F.stddev_pop("close").over(trailing(w, 20)))
        .withColumn("_c50", long_mean("c50", 50))
        .withColumn("_c200", long_mean("c200", 200))
        .withColumn("_v20", mean("volume", 20))
        .withColumn("_up", mean("gain", 14))
        .withColumn("_down", mean("loss", 14))
        .where("core")
        .select(
            *BAR_COLUMNS,
            "daily_return",
            from_bar(20, mid).alias("sma_20"),
            from_bar(50, F.col("_c50")).alias("sma_50"),
            from_bar(200, F.col("_c200")).alias("sma_200"),
            from_bar(20, F.col("_v20")).alias("vol_sma_20"),
            from_bar(15, 100.0 * up / F.nullif(up + down, F.lit(0.0))).alias("rsi_14"),
            from_bar(20, mid).alias("bb_mid_20"),
            from_bar(20, mid + 2 * dev).alias("bb_upper_20"),
            from_bar(20, mid - 2 * dev).alias("bb_lower_20"),
        )
    )
