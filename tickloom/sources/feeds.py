"""Recorded feed responses -> labelled bars.

Input is a table of responses (``symbol``, ``page``, ``response`` JSON text), one row per fetched
page. Parsing is a map over rows; only overlap removal groups, and it combines map-side. Each feed
returns two frames: bars, and rejects with a reason, so that no response or candle vanishes and a
bad one never stops the others. A price that is JSON null stays NULL; later layers flag it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import mask_secrets, number

# Field order of the array-shaped candles of the two crypto venues.
COINBASE_FIELDS = ("time", "low", "high", "open", "close", "volume")
KRAKEN_FIELDS = ("time", "open", "high", "low", "close", "vwap", "volume", "count")
# Catalog symbol to the second venue's pair name.
KRAKEN_PAIRS = {"BTC-USD": "XBTUSD", "ETH-USD": "ETHUSD"}
# Fixed value: candles one request of the first venue may return.
COINBASE_PAGE_DAYS = 300

PRICES = ("open", "high", "low", "close")
CANDLE_LIST = "array<string>"
REJECT_COLUMNS = ("source", "symbol", "granularity", "page", "reason", "raw")
#: Fixed value: last second of the year 9999; larger times are no times.
LAST_SECOND = 253_402_300_799


_MARKS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]', re.DOTALL)


def element_texts(text: str | None) -> list[str] | None:
    """The elements of a JSON array as they stand in ``text``, without the space around them.

    Only brackets and quoted strings are followed; whether the text is JSON is for others to judge.
    NULL if it is no array by these marks.
    """
    text = (text or "").strip()
    if not text.startswith("["):
        return None
    depth, start, found = 0, 1, []
    for mark in _MARKS.finditer(text):
        sign = mark.group()[0]
        if sign in "[{":
            depth += 1
        elif sign in "]}":
            depth -= 1
        if depth == 0 or (depth == 1 and sign == ","):
            element = text[start : mark.start()].strip()
            if element or found or depth:
                found.append(element)
            start = mark.end()
            if depth == 0:
                return found if start == len(text) else None
    return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _element_texts(texts: pd.Series) -> pd.Series:
    return texts.map(element_texts)


def _split(opened: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Elements of ``_list`` as raw text ``_x``, and the responses that hold no list.

    An empty list is an answer without candles, not a reject. ``reason`` may already name a cause.
    """
    marked = opened.withColumns({"source": F.lit(source), "granularity": F.lit("1d")})
    unread = F.col("_list").isNull() | F.col("reason").isNotNull()
    rejects = marked.where(unread).select(
        "source", "symbol", "granularity", "page",
        F.coalesce("reason", F.lit("no candle list")).alias("reason"),
        mask_secrets(F.col("response")).alias("raw"),
    )
    items = marked.where(~unread).select(
        "source", "symbol", "granularity", "page", F.explode("_list").alias("_x")
    )
    return items, rejects


def _finish(
    items: DataFrame, rejects: DataFrame, reason: Column, bar: list[Column]
) -> tuple[DataFrame, DataFrame]:
    """Bars of the elements without a ``reason``; the others join the rejects."""
    judged = items.withColumn("reason", reason)
    bars = judged.where("reason is null").select("source", "symbol", "granularity", *bar, "page")
    bad = judged.where("reason is not null").withColumn("raw", mask_secrets(F.col("_x")))
    return bars, rejects.unionByName(bad.select(*REJECT_COLUMNS))


def _unreadable(cells: Mapping[str, Column]) -> Column:
    """A cell that holds something, but no finite number."""
    bad = F.lit(False)
    for cell in cells.values():
        bad = bad | (cell.isNotNull() & number(cell).isNull())
    return bad


def _positional(
    opened: DataFrame, source: str, fields: tuple[str, ...], numbers_as_text: bool
) -> tuple[DataFrame, DataFrame]:
    """Label array-shaped candles; text numbers stay text in the payload."""
    items, rejects = _split(opened, source)
    items = items.withColumn("_r", F.from_json("_x", CANDLE_LIST))
    cells = {name: F.get("_r", F.lit(place)) for place, name in enumerate(fields)}
    whole = {c: number(cells[c]).try_cast("long") for c in ("time", "count") if c in cells}
    labelled = F.struct(
        *[
            whole.get(
                name, cell if numbers_as_text else number(cell)
            ).alias(name)
            for name, cell in cells.items()
        ]
    )
    reason = (
        F.when(F.col("_r").isNull() | (F.size("_r") < len(fields)), "incomplete candle")
        .when(whole["time"].isNull() | (F.abs(whole["time"]) > LAST_SECOND), "unreadable time")
        .when(_unreadable(cells), "unreadable number")
    )
    return _finish(
        items, rejects, reason,
        [
            F.timestamp_seconds(whole["time"]).alias("ts"),
            *[number(cells[p]).alias(p) for p in (*PRICES, "volume")],
            F.to_json(labelled).alias("payload"),
        ],
    )


def _listed(responses: DataFrame) -> DataFrame:
    return responses.withColumns(
        {"_list": F.from_json("response", CANDLE_LIST), "reason": F.lit(None).cast("string")}
    )


def coinbase_bars(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars and rejects (REJECT_COLUMNS); the same holds for every feed below."""
    return _positional(_listed(responses), "coinbase", COINBASE_FIELDS, False)


def kraken_bars(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars, and what cannot be read: a venue error, no candle list, or a bad candle."""
    envelope = F.from_json("response", "struct<error:array<string>,result:map<string,string>>")
    opened = responses.withColumn("_e", envelope)
    lists = F.map_filter(F.col("_e.result"), lambda k, _: k != "last")
    failed = F.size(F.coalesce(F.col("_e.error"), F.array().cast("array<string>"))) > 0
    opened = opened.withColumns(
        {
            "_list": F.from_json(F.get(F.map_values(lists), F.lit(0)), CANDLE_LIST),
            "reason": F.when(
                failed, F.concat(F.lit("venue error: "), F.array_join("_e.error", ","))
            ),
        }
    )
    return _positional(opened, "kraken", KRAKEN_FIELDS, True)


def _dated(
    responses: DataFrame, source: str, numbers: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Rows with a ``date``; the payload is the element's own text, unknown fields included.

    The JSON functions would write the elements anew (``1.10`` as ``1.1``, long numbers rounded), so
    they only decide whether the response is a list; the elements are cut out of its text. A
    response on whose elements both do not agree is a reject.
    """
    read = F.col("_list")
    own = F.when(read.isNotNull(), _element_texts("response"))
    listed = _listed(responses).withColumn("_own", own)
    agreed = F.when(F.size("_own") == F.size(read), F.col("_own"))
    items, rejects = _split(listed.withColumn("_list", agreed), source)
    items = items.withColumn("_m", F.from_json("_x", "map<string,string>"))
    cells = {c: F.try_element_at("_m", F.lit(c)) for c in numbers}
    ts = F.try_to_timestamp(F.try_element_at("_m", F.lit("date")))
    lacking = F.lit(False)
    for c in PRICES:
        lacking = lacking | ~F.map_contains_key("_m", c)
    reason = (
        F.when(F.col("_m").isNull() | lacking, "incomplete candle")
        .when(ts.isNull(), "unreadable time")
        .when(_unreadable(cells), "unreadable number")
    )
    volume = number(cells["volume"]) if "volume" in cells else F.lit(None).cast("double")
    return _finish(
        items, rejects, reason,
        [
            ts.alias("ts"),
            *[number(cells[p]).alias(p) for p in PRICES],
            volume.alias("volume"),
            F.col("_x").alias("payload"),
        ],
    )


def equity_bars(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _dated(responses, "tiingo", (*PRICES, "volume"))


def fx_bars(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FX rows carry no volume key; volume is NULL, never zero."""
    return _dated(responses, "tiingo_fx", PRICES)


def map_symbols(
    df: DataFrame, pairs: Mapping[str, str] = KRAKEN_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """Add the venue's ``pair`` name; symbols without one are returned as rejects."""
    table = F.create_map(*[F.lit(x) for item in pairs.items() for x in item])
    mapped = df.withColumn("pair", F.try_element_at(table, F.col("symbol")))
    return mapped.where("pair is not null"), mapped.where("pair is null").drop("pair")


def fx_ticker(symbol: Column) -> Column:
    return F.lower(symbol)


def clip_window(bars: DataFrame, start: Column, end: Column) -> DataFrame:
    """Keep bars inside the closed window; of repeats from overlapping pages the last page wins."""
    keys = ["source", "symbol", "granularity", "ts"]
    rest = [c for c in bars.columns if c not in (*keys, "page")]
    return (
        bars.where(F.col("ts").between(start, end))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "page").alias("_b"))
        .select(*keys, "_b.*")
    )


def page_windows(windows: DataFrame, days: int = COINBASE_PAGE_DAYS) -> DataFrame:
    """Split each [window_start, window_end] into closed, disjoint chunks of at most ``days``."""
    starts = F.sequence(
        F.col("window_start"), F.col("window_end"), F.make_dt_interval(F.lit(days))
    )
    return (
        windows.where("window_start <= window_end")
        .withColumn("page_start", F.explode(starts))
        .withColumn(
            "page_end",
            F.least(F.col("page_start") + F.make_dt_interval(F.lit(days - 1)), "window_end"),
        )
    )


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Scan recorded responses kept as JSON lines."""
    return spark.read.schema("symbol string, page int, response string").json(path)
