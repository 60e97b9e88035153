"""Market-shaped inputs derived from the given tables, and the layers queries share.

The given tables hold no market bars, so orders play that part: a priority class is a symbol, an
order date is a bar, and a damped order total is a price (damped so that compounding over hundreds
of trades stays finite). Everything is built by Spark from whole tables.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import class_has_volume
from tickloom.operators.accounting import (
    Costs,
    active_bars,
    assemble_runs,
    curve_points,
    score_variants,
    with_history,
)
from tickloom.operators.indicators import indicators
from tickloom.operators.signals import DEFAULT_SIGNALS, configure, resolve_signals, signal_base
from tickloom.operators.variants import lattice
from tickloom.plans import marts, silver
from tickloom.session import materialise, prepare
from tickloom.sources.tables import run_curves

#: The latch never triggers on this data at its default period, so a quicker one is used.
QUICK_LATCH = {"period": 5, "entry_below": 40, "exit_above": 60}
SIGNALS = tuple(
    {**entry, "params": QUICK_LATCH} if entry["name"] == "rsi_reversion" else entry
    for entry in DEFAULT_SIGNALS
)

_CLASSES = {"1-URGENT": "crypto", "5-LOW": "fx"}
_REGIONS = {"1-URGENT": "global", "2-HIGH": "latam", "3-MEDIUM": "us", "4-NOT SPECIFIED": "latam"}
_FX_PAIRS = {"2-HIGH": "5-LOW", "4-NOT SPECIFIED": "5-LOW"}
#: Symbols the second venue has a pair for; the others are rejects.
PAIRS = {"1-URGENT": "XURGENT", "2-HIGH": "XHIGH", "3-MEDIUM": "XMEDIUM"}
PAGE_DAYS = 300


def _choose(column: Column, table: dict[str, str], default: str | None) -> Column:
    picked = F.lit(default)
    for key, value in table.items():
        picked = F.when(column == key, F.lit(value)).otherwise(picked)
    return picked


def bars_from(rows: DataFrame, symbol: Column) -> DataFrame:
    """Daily bars; one aggregation with a map-side part, so a hot symbol is reduced first."""
    priced = rows.select(
        symbol.alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        (F.lit(1000) + F.col("o_totalprice") / 500).alias("price"),
        F.col("o_orderkey").alias("k"),
    )
    return priced.groupBy("symbol", "ts").agg(
        F.min_by("price", "k").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "k").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
        F.max("k").alias("k"),
    )


class Warehouse:
    """Layers over one data folder. Heavy layers are written once and read back."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.signals = configure(SIGNALS)
        self.variants = lattice(self.signals)
        self.costs = Costs()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- bars -----------------------------------------------------------------------------
    @cached_property
    def bars(self) -> DataFrame:
        """Five symbols; the currency symbol has no volume."""
        made = bars_from(self.table("orders"), F.col("o_orderpriority"))
        volume = F.when(F.col("symbol") != "5-LOW", F.col("volume"))
        return materialise(made.withColumn("volume", volume), "bars")

    @cached_property
    def bars125(self) -> DataFrame:
        """One symbol per (nation, priority)."""
        rows = self.table("orders").join(
            self.table("customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        symbol = F.concat_ws("/", F.col("c_nationkey").cast("string"), "o_orderpriority")
        return materialise(bars_from(rows, symbol), "bars125")

    @cached_property
    def catalog(self) -> DataFrame:
        symbol = F.col("o_orderpriority")
        assets = self.table("orders").select(symbol.alias("symbol")).distinct()
        s = F.col("symbol")
        classed = assets.withColumn("asset_class", _choose(s, _CLASSES, "equity"))
        return classed.select(
            "symbol",
            "asset_class",
            _choose(s, _REGIONS, "emerging").alias("region"),
            F.concat(F.lit("Asset "), s).alias("name"),
            class_has_volume(F.col("asset_class")).alias("has_volume"),
            _choose(s, _FX_PAIRS, None).alias("fx_pair"),
        )

    @cached_property
    def as_of(self) -> dt.datetime:
        """Clock of the deterministic runs: the newest bar (one aggregated value)."""
        return self.bars.agg(F.max("ts")).first()[0]

    # --- bronze ---------------------------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        """Bronze candles of four sources with overlapping coverage."""
        b = self.bars
        text = [F.col(c).cast("string").alias(c) for c in ("open", "high", "low")]
        moved = F.col("close") * (1 + (F.col("k") % 17 - 8) * 0.0007)
        seconds = F.unix_seconds("ts").alias("time")
        day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date")
        volume = F.coalesce(F.col("volume"), F.col("k") % 3).cast("double")
        equity = F.col("symbol").isin("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")

        def candles(source: str, where: Column, *fields: Column | str) -> DataFrame:
            return b.where(where).select(
                F.lit(source).alias("source"),
                "symbol",
                F.lit("1d").alias("granularity"),
                F.col("ts").alias("candle_ts"),
                F.to_json(F.struct(*fields)).alias("payload"),
                "k",
            )

        return (
            candles("coinbase", F.col("k") % 7 != 0, seconds, "low", "high", "open", "close",
                    volume.alias("volume"))
            .unionByName(candles("kraken", F.lit(True), seconds, *text,
                                 moved.cast("string").alias("close"),
                                 volume.cast("string").alias("volume")))
            .unionByName(candles("tiingo", equity & (F.col("k") % 3 == 0), day, "open", "high",
                                 "low", "close", volume.alias("volume"),
                                 (F.col("close") * 0.5).alias("adjClose")))
            .unionByName(candles("tiingo_fx", (F.col("symbol") == "5-LOW") & (F.col("k") % 5 == 0),
                                 day, F.lower("symbol").alias("ticker"), "open", "high", "low",
                                 "close"))
        )

    @cached_property
    def typed(self) -> DataFrame:
        return silver.all_sources(self.raw)

    @cached_property
    def canonical(self) -> DataFrame:
        return materialise(silver.canonical(self.typed), "canonical")

    @cached_property
    def reconciliation(self) -> DataFrame:
        return marts.source_reconciliation(self.typed)

    def responses(self, kind: str) -> DataFrame:
        """Recorded pages of at most ``PAGE_DAYS`` days; a page also repeats the first days of the
        next one with a shifted close, which the later page must override."""
        page = F.floor(F.unix_date(F.to_date("ts")) / PAGE_DAYS).cast("int")
        early = F.unix_date(F.to_date("ts")) % PAGE_DAYS < 5
        pages = F.when(early, F.array(page, page - 1)).otherwise(F.array(page))
        rows = self.bars.withColumn("home", page).withColumn("page", F.explode(pages))
        close = F.when(F.col("page") == F.col("home"), F.col("close")).otherwise(
            F.col("close") + 1
        )
        rows = rows.withColumn("close", close).withColumn(
            "volume", F.coalesce("volume", F.lit(1.0))
        )
        time = F.unix_seconds("ts").cast("string")
        day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

        def quoted(c: str) -> Column:
            return F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))

        if kind == "coinbase":
            cells = F.concat_ws(
                ",", time, *[F.col(c).cast("string") for c in
                             ("low", "high", "open", "close", "volume")]
            )
            item = F.concat(F.lit("["), cells, F.lit("]"))
        elif kind == "kraken":
            cells = F.concat_ws(
                ",", time, *[quoted(c) for c in
                             ("open", "high", "low", "close", "open", "volume")], F.lit("7")
            )
            item = F.concat(F.lit("["), cells, F.lit("]"))
        elif kind == "equity":
            item = F.to_json(
                F.struct(day.alias("date"), "open", "high", "low", "close", "volume",
                         (F.col("close") * 0.5).alias("adjClose"))
            )
        else:
            item = F.to_json(
                F.struct(day.alias("date"), F.lower("symbol").alias("ticker"), "open", "high",
                         "low", "close")
            )
        listed = rows.groupBy("symbol", "page").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("list")
        )
        if kind != "kraken":
            return listed.select("symbol", "page", F.col("list").alias("response"))
        good = F.concat(
            F.lit('{"error":[],"result":{"X'), F.col("symbol"), F.lit('":'), "list",
            F.lit(',"last":1}}'),
        )
        body = (
            F.when(F.col("page") % 5 == 0, F.lit('{"error":["EGeneral:Busy"]}'))
            .when(F.col("page") % 5 == 1, F.lit('{"error":[],"result":{"last":1}}'))
            .otherwise(good)
        )
        return listed.select("symbol", "page", body.alias("response"))

    @cached_property
    def audit(self) -> DataFrame:
        """Ingest attempts from the event stream; errors are failed attempts."""
        failed = F.col("event_type") == "error"
        source = F.element_at(
            F.array(*[F.lit(s) for s in ("coinbase", "kraken", "tiingo", "tiingo_fx")]),
            (F.col("user_id") % 4 + 1).cast("int"),
        )
        text = F.format_string(
            "HTTPError: https://feed/x?token=%s&n=%s API_KEY=%s", F.sha2(
                F.col("event_id").cast("string"), 256),
            F.col("event_id").cast("string"), F.col("user_id").cast("string"),
        )
        return self.table("events").select(
            F.col("event_id").alias("ingest_run_id"),
            source.alias("source"),
            F.col("event_type").alias("symbol"),
            F.lit("1d").alias("granularity"),
            F.floor("value").cast("long").alias("rows_fetched"),
            F.when(failed, 0).otherwise(F.floor("value")).cast("long").alias("rows_inserted"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            F.when(failed, text).alias("error"),
            F.col("ts").cast("timestamp").alias("started_at"),
            (F.col("ts").cast("timestamp") + F.expr("interval 2 seconds")).alias("finished_at"),
            (failed & (F.col("user_id") % 5 == 0)).alias("rate_limited"),
            (failed & (F.col("user_id") % 11 == 3)).alias("auth_failed"),
        )

    # --- scored layers ----------------------------------------------------------------------
    @cached_property
    def indicator_rows(self) -> DataFrame:
        return materialise(indicators(self.bars), "indicators")

    @cached_property
    def signal_rows(self) -> DataFrame:
        return self._resolved(self.bars)

    def _resolved(self, bars: DataFrame) -> DataFrame:
        """Signals of ``bars``; both stages are written, because each is read more than once."""
        base = materialise(signal_base(bars, self.signals), "signal_base")
        return materialise(resolve_signals(base, self.signals), "signals")

    @cached_property
    def signal_rows125(self) -> DataFrame:
        return self._resolved(self.bars125)

    @cached_property
    def active(self) -> DataFrame:
        return active_bars(
            with_history(self.signal_rows, self.signals), self.variants, self.costs
        )

    @cached_property
    def metrics(self) -> DataFrame:
        scored = score_variants(
            self.signal_rows, self.catalog, self.signals, self.variants, self.costs
        )
        return materialise(scored, "metrics")

    @cached_property
    def runs(self) -> DataFrame:
        return materialise(assemble_runs(self.metrics, self.costs, F.lit(self.as_of)), "runs")

    @cached_property
    def history(self) -> DataFrame:
        """Two generations of runs. The new one has unscored windows and legacy component lists
        for some variants; the old one has different figures."""
        unscored = F.col("mask") % 7 == 0
        new = self.runs
        for c in new.columns:
            if c.startswith(("is_", "oos_")) or c == "n_trades":
                new = new.withColumn(c, F.when(~unscored, F.col(c)))
        empty = F.array().cast("array<string>")
        new = new.withColumn(
            "components",
            F.when(F.col("mask") % 9 == 0, empty).otherwise(F.col("components")),
        )
        old = (
            self.runs.withColumn("executed_at", F.lit(self.as_of - dt.timedelta(days=1)))
            .withColumn("total_return", F.col("total_return") * 0.5)
            .withColumn("backtest_run_id", F.concat(F.lit("old-"), "backtest_run_id"))
        )
        return new.unionByName(old)

    @cached_property
    def variant_mart(self) -> DataFrame:
        """Written like any gold table, because many summaries read it."""
        return materialise(marts.combination_analysis(self.history, self.catalog), "variants")

    @cached_property
    def fx_mart(self) -> DataFrame:
        return marts.fx_decomposition(self.bars, self.catalog)

    @cached_property
    def index_rows(self) -> DataFrame:
        """The published index as read back, for the queries of its sections."""
        from tickloom.registry.publishing import _sections

        return _sections(self)

    @cached_property
    def single_curves(self) -> DataFrame:
        """Stored with the position ``rn`` and length ``n`` of each curve: it has every bar."""
        singles = [v for v in self.variants if len(v.components) == 1]
        points = curve_points(self.signal_rows, self.signals, singles, self.costs)
        kept = self.runs.select("symbol", "strategy")
        return materialise(points.join(kept, ["symbol", "strategy"], "left_semi"), "curves")

    @cached_property
    def run_curve_rows(self) -> DataFrame:
        """Curve points of the stored runs of both generations."""
        return run_curves(
            self.single_curves.select("symbol", "strategy", "ts", "equity", "buy_hold_equity"),
            self.history,
        )


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, sf_dir)
    return _OPEN[key]
