"""Registered queries: indicators, signals, variants, accounting, runs."""

from __future__ import annotations

import datetime as dt


from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.functions.ranking import latest_per_key
from tickloom.functions.series import (
    chunk_order,
    evenly_spaced,
    full_max,
    full_mean,
    full_min,
    number_bars,
    running_peak,
    spread,
)
from tickloom.operators.accounting import (
    assemble_runs,
    best_variants,
    round_trips,
    score_variants,
    symbol_bounds,
)
from tickloom.operators.indicators import price_changes
from tickloom.operators.retention import (
    backfill_components,
    cascade,
    pruned_count,
    retain,
)
from tickloom.operators.signals import (
    Recursion,
    Signal,
    align_external,
    cutler_rsi,
    pack,
    resolve_signals,
    signal_base,
)
from tickloom.operators.variants import (
    available_mask,
    expand_variants,
    lattice,
    split_at,
    warm_start,
)
from tickloom.plans import marts
from tickloom.registry.adapters import Warehouse
from tickloom.registry.spec import Entry
from tickloom.sources.catalog import restrict
from tickloom.sources.json_sinks import split_boundary


def _in_chunks(w: Warehouse, lookback: int):
    return price_changes(spread(number_bars(w.bars), lookback))


def _numbered(w: Warehouse):
    return number_bars(w.bars)


def _averages(w: Warehouse):
    order = chunk_order()
    return (
        _in_chunks(w, 60)
        .withColumn("close_50", full_mean("close", order, 50))
        .withColumn("volume_20", full_mean("volume", order, 20))
        .where("core")
    )


def _rsi(w: Warehouse):
    return _in_chunks(w, 20).withColumn("rsi", cutler_rsi(chunk_order(), 14)).where("core")


def _extremes(w: Warehouse):
    order = chunk_order()
    return (
        _in_chunks(w, 100)
        .withColumn("top", full_max("high", order, 100))
        .withColumn("bottom", full_min("low", order, 100))
        .where("core")
    )


def _peaks(w: Warehouse):
    chunked = spread(number_bars(w.bars), 0)
    return running_peak(chunked.select("symbol", "ts", "rn", "chunk", "close"), "close",
                        ("symbol",))


def _volume(w: Warehouse):
    return w.bars.groupBy("symbol").agg(
        (F.count_if(F.col("volume") != 0) > 0).alias("has_tape")
    )


def _symbols(w: Warehouse):
    """One row per symbol with its length, tape and class."""
    bounds = w.bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("volume") != 0).alias("live_volume")
    )
    return bounds.join(w.catalog.select("symbol", "asset_class"), "symbol").withColumn(
        "available", available_mask(w.signals)
    )


def _lattice(w: Warehouse):
    return expand_variants(_symbols(w), w.variants)


def _singles_only(w: Warehouse):
    return expand_variants(_symbols(w), lattice(w.signals, combinations=False))


def _splits(w: Warehouse):
    n, warmup = F.col("n"), F.col("warmup")
    return (
        _lattice(w)
        .withColumn("start", warm_start(n, warmup))
        .withColumn("split", split_at(n, warmup, w.costs.train_fraction))
    )


def _composed(w: Warehouse):
    """Bars on which every component of a variant is on."""
    packed = w.signal_rows.groupBy("symbol", pack(w.signals).alias("bits")).agg(
        F.count(F.lit(1)).alias("bars")
    )
    masks = F.array(*[F.lit(v.mask) for v in w.variants])
    on = F.filter(masks, lambda m: F.col("bits").bitwiseAND(m) == m)
    counted = (
        packed.withColumn("mask", F.explode(on))
        .groupBy("symbol", "mask")
        .agg(F.sum("bars").alias("bars_on"))
    )
    joined = _lattice(w).select("symbol", "mask", "strategy").join(
        counted, ["symbol", "mask"], "left"
    )
    return joined.withColumn("bars_on", F.coalesce("bars_on", F.lit(0)))


def _edges(w: Warehouse):
    """Open and close at the edges of the full window, with the buy & hold return."""
    bounds = symbol_bounds(w.signal_rows, w.variants, w.costs.train_fraction)
    return bounds.withColumn(
        "buy_hold", F.col("close_full") / (F.col("open_full") * w.costs.buy) - 1
    )


def _external(w: Warehouse):
    """A foreign signal that misses some bars and carries some bad values."""
    k = F.col("k")
    value = F.when(k % 11 == 0, F.lit(7)).otherwise((k % 2).cast("int"))
    foreign = w.bars.where(k % 13 != 0).select("symbol", "ts", value.alias("signal"))
    return align_external(w.bars, foreign)


def double_average(params):
    """A signal of somebody else: the close above a doubled exponential average of itself."""
    span = params["span"]
    q = 1.0 - 2.0 / (span + 1.0)

    def inputs():
        moved = F.col("close") - F.col("close0")
        return (1 - q) * moved, (1 - q) * (1 - q) * moved

    def decide(state):
        return F.col("close") - F.col("close0") > 2 * state[0] - state[1]

    recursion = Recursion(((q, 0.0), ((1 - q) * q, q)), inputs, decide)
    return Signal("double_average", params, span, 0, "linear", recursion=recursion)


def _foreign_linear(w: Warehouse):
    """The signal over chunks of 500 bars, so that its state crosses chunks at every scale."""
    signals = [double_average({"span": 21})]
    base = signal_base(w.bars, signals, chunk_bars=500)
    return resolve_signals(base, signals, chunk_bars=500)


def _fine_bars(w: Warehouse):
    """Minute and hour bars of the event stream, keyed by symbol and granularity."""
    events = w.table("events").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("at"), "value", "event_id"
    )
    made = None
    for granularity, unit in (("1m", "minute"), ("1h", "hour")):
        part = events.groupBy("symbol", F.date_trunc(unit, "at").alias("ts")).agg(
            F.max_by("value", "event_id").alias("close")
        ).withColumn("granularity", F.lit(granularity))
        made = part if made is None else made.unionByName(part)
    keys = ("symbol", "granularity")
    numbered = number_bars(made, keys, bar_seconds=None, chunk_bars=64)
    order = chunk_order(keys)
    spread_out = spread(numbered, 20, chunk_bars=64)
    return spread_out.withColumn("mean_20", full_mean("close", order, 20)).where("core")


def _three_generations(w: Warehouse):
    """Two runs kept of each variant out of three, where one variant in seven has only the newest."""
    older = w.runs.where("mask % 7 <> 0").withColumn(
        "executed_at", F.lit(w.as_of - dt.timedelta(days=2))
    ).withColumn("backtest_run_id", F.concat(F.lit("older-"), "backtest_run_id"))
    old = w.runs.where("mask % 7 <> 0").withColumn(
        "executed_at", F.lit(w.as_of - dt.timedelta(days=1))
    ).withColumn("backtest_run_id", F.concat(F.lit("old-"), "backtest_run_id"))
    whole = w.runs.unionByName(old).unionByName(older)
    return retain(whole, 2).groupBy("symbol", "executed_at").agg(F.count(F.lit(1)).alias("kept"))


def _causality(w: Warehouse):
    """Signals of a truncated history against the same bars of the whole history."""
    cut = F.lit(w.as_of - dt.timedelta(days=700))
    early = w.bars.where(F.col("ts") <= cut)
    prefix = resolve_signals(signal_base(early, w.signals), w.signals)
    both = prefix.select("symbol", "ts", pack(w.signals).alias("early")).join(
        w.signal_rows.select("symbol", "ts", pack(w.signals).alias("late")), ["symbol", "ts"]
    )
    return both.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if(F.col("early") != F.col("late")).alias("changed"),
    )


def _binary(w: Warehouse):
    """Count of signal values outside {0, 1}, per symbol."""
    bad = [
        F.count_if(F.coalesce(~F.col(f"sig_{s.name}").isin(0, 1), F.lit(True))).alias(s.name)
        for s in w.signals
    ]
    return w.signal_rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), *bad)


def _wide(w: Warehouse):
    """Every variant and window over one symbol per nation and priority."""
    resolved = w.signal_rows125
    classes = w.bars125.select("symbol").distinct().withColumn("asset_class", F.lit("equity"))
    return score_variants(resolved, classes, w.signals, w.variants, w.costs)


def _thinned(w: Warehouse):
    return w.single_curves.where(evenly_spaced(F.col("rn"), F.col("n"), 400)).withColumns(
        {c: scalars.half_even(F.col(c), 2) for c in ("equity", "buy_hold_equity")}
    )


def _best(w: Warehouse):
    return best_variants(w.metrics).withColumn(
        "label", scalars.best_label(F.col("excess_return"), F.col("strategy"))
    )


def _retained(w: Warehouse):
    return retain(w.history, 1)


def _by_run(w: Warehouse, kept):
    points = kept.groupBy("backtest_run_id").agg(F.count(F.lit(1)).alias("points"))
    return points.join(
        w.history.select("backtest_run_id", "symbol", "strategy", "executed_at"),
        "backtest_run_id",
    )


METRICS = (
    "symbol:s strategy:s window:s bars:i total_return:d5 cagr:d5 buy_hold_return:d6 "
    "max_drawdown:d6 sharpe:d6 n_trades:i win_rate:d9 exposure:d9"
)

BARS125 = """
    SELECT c_nationkey || '/' || o_orderpriority AS symbol, o_orderdate AS ts,
           arg_min(1000 + o_totalprice / 500, o_orderkey) AS open,
           max(1000 + o_totalprice / 500) AS high, min(1000 + o_totalprice / 500) AS low,
           arg_max(1000 + o_totalprice / 500, o_orderkey) AS close,
           count(*)::DOUBLE AS volume, max(o_orderkey) AS k
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2"""
CATALOG125 = "SELECT DISTINCT symbol, 'equity' AS asset_class FROM bars"

RUN_COLUMNS = (
    "symbol:s strategy:s strategy_kind:s components:a n_components:i n_bars:i has_curve:b "
    "executed_at:t split_ts:t total_return:d5 cagr:d5 buy_hold_return:d6 max_drawdown:d6 "
    "sharpe:d6 n_trades:i win_rate:d6 exposure:d6"
)
WINDOW_COLUMNS = (
    "symbol:s strategy:s is_total_return:d5 is_buy_hold_return:d6 is_sharpe:d6 "
    "is_max_drawdown:d6 is_n_trades:i is_exposure:d6 oos_total_return:d5 "
    "oos_buy_hold_return:d6 oos_sharpe:d6 oos_max_drawdown:d6 oos_n_trades:i oos_exposure:d6"
)


def _signal(name: str) -> Entry:
    short = {
        "sma_cross": ("signals_sma", "B1 B3"),
        "macd": ("signals_macd", "B4"),
        "rsi_reversion": ("signals_rsi_latch", "B5 W11"),
        "volume_breakout": ("signals_volume", "B6"),
        "fibonacci": ("signals_fib", "B7"),
    }[name]
    return Entry(
        short[0], short[1], "symbol:s ts:t on:i",
        lambda w: w.signal_rows.withColumn("on", F.col(f"sig_{name}")),
        f'SELECT symbol, ts, {name} AS "on" FROM sig',
    )


ENTRIES = [
    Entry("linear_signal", "X1 B4", "symbol:s ts:t sig_double_average:i", _foreign_linear,
          """SELECT n.symbol, n.ts, (n.close > 2 * a.e1 - a.e2)::INT AS sig_double_average
             FROM num n JOIN averages a USING (symbol, rn)"""),
    Entry("fine_bars", "W1 W3 B1", "symbol:s granularity:s ts:t rn:i n:i mean_20:d6", _fine_bars,
          """SELECT symbol, granularity, ts, row_number() OVER w - 1 AS rn,
                    count(*) OVER (PARTITION BY symbol, granularity) AS n,
                    CASE WHEN row_number() OVER w >= 20 THEN avg(close) OVER (PARTITION BY symbol,
                        granularity ORDER BY ts ROWS 19 PRECEDING) END AS mean_20
             FROM (SELECT event_type AS symbol, unit AS granularity,
                          CASE unit WHEN '1m' THEN date_trunc('minute', ts) ELSE date_trunc('hour', ts) END
                              AS ts, arg_max(value, event_id) AS close
                   FROM events, (VALUES ('1m'), ('1h')) u(unit) GROUP BY 1, 2, 3)
             WINDOW w AS (PARTITION BY symbol, granularity ORDER BY ts)"""),
    Entry("retention_three_generations", "J13 W10", "symbol:s executed_at:t kept:i", _three_generations,
          """SELECT symbol, as_of - to_days(back::INT) AS executed_at, count(*) AS kept
             FROM lat, clock, (VALUES (0), (1)) g(back) WHERE back = 0 OR mask % 7 <> 0
             GROUP BY 1, 2"""),
    Entry("indicators", "W1 W2 W3 W4 W5 W6 M3",
          "symbol:s ts:t open:d6 high:d6 low:d6 close:d6 volume:d6 daily_return:d6 sma_20:d8 "
          "sma_50:d8 sma_200:d9 vol_sma_20:d8 rsi_14:d6 bb_mid_20:d8 bb_upper_20:d6 "
          "bb_lower_20:d6", lambda w: w.indicator_rows,
          """SELECT *, sma_20 AS bb_mid_20, sma_20 + 2 * dev_20 AS bb_upper_20,
                    sma_20 - 2 * dev_20 AS bb_lower_20 FROM ind"""),
    Entry("bar_numbers", "W1", "symbol:s ts:t rn:i n:i", _numbered,
          "SELECT symbol, ts, rn, n FROM num"),
    Entry("price_changes", "P4 P5 W2", "symbol:s ts:t daily_return:d6 gain:d6 loss:d6",
          lambda w: _in_chunks(w, 1).where("core"),
          """SELECT symbol, ts, delta / nullif(close - delta, 0) AS daily_return,
                    CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS gain,
                    CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS loss FROM num"""),
    Entry("moving_averages", "B1", "symbol:s ts:t close_50:d8 volume_20:d8", _averages,
          """SELECT symbol, ts, CASE WHEN rn >= 49 THEN avg(close) OVER
                        (PARTITION BY symbol ORDER BY rn ROWS 49 PRECEDING) END AS close_50,
                    CASE WHEN rn >= 19 AND volume IS NOT NULL THEN avg(volume) OVER
                        (PARTITION BY symbol ORDER BY rn ROWS 19 PRECEDING) END AS volume_20
             FROM num"""),
    Entry("cutler_rsi", "B2", "symbol:s ts:t rsi:d6", _rsi,
          "SELECT symbol, ts, coalesce(rsi_14, 100) AS rsi FROM ind WHERE rsi_14 IS NOT NULL "
          "UNION ALL SELECT symbol, ts, NULL FROM ind WHERE rsi_14 IS NULL"),
    Entry("rolling_extremes", "W13", "symbol:s ts:t top:d6 bottom:d6", _extremes,
          """SELECT symbol, ts, CASE WHEN rn >= 99 THEN max(high) OVER w END AS top,
                    CASE WHEN rn >= 99 THEN min(low) OVER w END AS bottom FROM num
             WINDOW w AS (PARTITION BY symbol ORDER BY rn ROWS 99 PRECEDING)"""),
    Entry("running_peak", "W12", "symbol:s ts:t peak:d6", _peaks,
          """SELECT symbol, ts, max(close) OVER (PARTITION BY symbol ORDER BY rn) AS peak
             FROM num"""),
    *[_signal(n) for n in ("sma_cross", "macd", "rsi_reversion", "volume_breakout", "fibonacci")],
    Entry("volume_availability", "B9", "symbol:s has_tape:b", _volume,
          "SELECT symbol, coalesce(max(volume), 0) > 0 AS has_tape FROM bars GROUP BY 1"),
    Entry("variant_lattice", "B10 B11 J15 P16",
          "symbol:s strategy:s components:a n_components:i mask:i", _lattice,
          "SELECT * FROM lat"),
    Entry("singles_only", "B11", "symbol:s strategy:s n_components:i", _singles_only,
          "SELECT * FROM lat WHERE n_components = 1"),
    Entry("and_composition", "B12", "symbol:s strategy:s bars_on:i", _composed,
          """SELECT l.symbol, l.strategy, count_if(s.bits & l.mask = l.mask) AS bars_on
             FROM lat l JOIN sig s USING (symbol) GROUP BY 1, 2"""),
    Entry("split_points", "B13 B14", "symbol:s strategy:s warmup:i start:i split:i", _splits,
          "SELECT *, warm AS warmup FROM lat"),
    Entry("signal_checks", "B27", "symbol:s bars:i fibonacci:i macd:i rsi_reversion:i "
          "sma_cross:i volume_breakout:i", _binary,
          """SELECT symbol, count(*) AS bars, 0 AS fibonacci, 0 AS macd, 0 AS rsi_reversion,
                    0 AS sma_cross, 0 AS volume_breakout FROM bars GROUP BY 1"""),
    Entry("causality", "B26", "symbol:s bars:i changed:i", _causality,
          """SELECT symbol, count(*) AS bars, 0 AS changed FROM bars, clock
             WHERE ts <= as_of - INTERVAL 700 DAY GROUP BY 1"""),
    Entry("external_signals", "B28", "symbol:s ts:t signal:i", lambda w: _external(w)[0],
          "SELECT symbol, ts, k % 2 AS signal FROM bars WHERE k % 13 <> 0 AND k % 11 <> 0"),
    Entry("external_signal_rejects", "B28", "symbol:s ts:t reason:s", lambda w: _external(w)[1],
          """SELECT symbol, ts, CASE k % 13 WHEN 0 THEN 'no signal for bar' ELSE 'not 0 or 1' END
                 AS reason FROM bars WHERE k % 13 = 0 OR k % 11 = 0"""),
    Entry("positions", "B16", "symbol:s strategy:s ts:t position:i",
          lambda w: w.single_curves,
          "SELECT symbol, strategy, ts, held::INT AS position FROM curve"),
    Entry("equity_curve", "B17", "symbol:s strategy:s ts:t equity:d1", lambda w: w.single_curves,
          "SELECT symbol, strategy, ts, equity FROM curve"),
    Entry("buy_hold", "B19", "symbol:s strategy:s ts:t buy_hold_equity:d4",
          lambda w: w.single_curves, "SELECT symbol, strategy, ts, buy_hold_equity FROM curve"),
    Entry("window_edges", "B19", "symbol:s n:i start_ts:t end_ts:t open_full:d6 close_full:d6 "
          "buy_hold:d6", _edges,
          """SELECT symbol, count(*) AS n, min(ts) AS start_ts, max(ts) AS end_ts,
                    arg_min(open, ts) AS open_full, arg_max(close, ts) AS close_full,
                    arg_max(close, ts) / (arg_min(open, ts) * 1.0005 * 1.001) - 1 AS buy_hold
             FROM bars GROUP BY 1"""),
    Entry("trades", "B18", "symbol:s strategy:s window:s entry_ts:t exit_ts:t entry_fill:d9 "
          "exit_fill:d9 return_pct:d6",
          lambda w: round_trips(w.active, w.variants, w.costs).join(
              w.metrics.where("total_return is not null").select("symbol", "strategy", "window"),
              ["symbol", "strategy", "window"], "left_semi"),
          """SELECT x.symbol, v.strategy, x."window", a.ts AS entry_ts, b.ts AS exit_ts,
                    a.open * 1.0005 AS entry_fill, b.open * 0.9995 AS exit_fill,
                    x.trade AS return_pct
             FROM trips x JOIN trips e ON e.symbol = x.symbol AND e.mask = x.mask
                  AND e."window" = x."window" AND e.trip = x.trip AND e.opens
             JOIN sig a ON a.symbol = x.symbol AND a.rn = e.rn
             JOIN sig b ON b.symbol = x.symbol AND b.rn = x.rn
             JOIN variant_list v ON v.mask = x.mask WHERE x.trade IS NOT NULL"""),
    Entry("windowed_metrics", "B15 B20 B21 B22 B23 A14", METRICS, lambda w: w.metrics,
          "SELECT * FROM met"),
    # Annualising a window of a few bars gives figures beyond any fixed number of digits.
    Entry("wide_universe_metrics", "B15 B20 B21 B22 B23", METRICS.replace("cagr:d5 ", ""), _wide, "SELECT * FROM met",
          (("bars", BARS125), ("catalog", CATALOG125))),
    Entry("run_metrics", "B25 M11", RUN_COLUMNS, lambda w: assemble_runs(
        w.metrics, w.costs, F.lit(w.as_of)), "SELECT * FROM runs"),
    Entry("window_columns", "S13", WINDOW_COLUMNS, lambda w: w.runs, "SELECT * FROM runs"),
    Entry("best_variant", "B24", "symbol:s window:s strategy:s excess_return:d5", _best,
          """SELECT symbol, "window", strategy, total_return - buy_hold_return AS excess_return
             FROM met WHERE "window" <> 'is' AND total_return IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY symbol, "window" ORDER BY
                 total_return - buy_hold_return DESC, n_components, strategy) = 1"""),
    Entry("best_label", "P22", "symbol:s window:s label:s", _best,
          """SELECT symbol, "window", printf('%+.2f%% (%s)',
                    100 * (total_return - buy_hold_return), strategy) AS label
             FROM met WHERE "window" <> 'is' AND total_return IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY symbol, "window" ORDER BY
                 total_return - buy_hold_return DESC, n_components, strategy) = 1"""),
    Entry("latest_runs", "W8", "symbol:s strategy:s executed_at:t total_return:d5",
          lambda w: marts.latest_runs(w.history),
          "SELECT symbol, strategy, executed_at, total_return FROM runs"),
    Entry("first_and_last_bar", "W8 W9", "symbol:s first_ts:t first_close:d6 end_ts:t end_close:d6",
          lambda w: marts.ends(w.bars).join(
              w.bars.groupBy("symbol").agg(F.min("ts").alias("first_ts"),
                                           F.min_by("close", "ts").alias("first_close")),
              "symbol"),
          """SELECT DISTINCT symbol, first_value(ts) OVER w AS first_ts,
                    first_value(close) OVER w AS first_close, last_value(ts) OVER w AS end_ts,
                    last_value(close) OVER w AS end_close FROM bars
             WINDOW w AS (PARTITION BY symbol ORDER BY ts
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""),
    Entry("latest_event_per_source", "W8", "source:s ingest_run_id:i started_at:t",
          lambda w: latest_per_key(w.audit, ["source"], F.col("started_at").desc(),
                                   F.col("ingest_run_id").desc()),
          """SELECT source, arg_max(ingest_run_id, started_at) AS ingest_run_id,
                    max(started_at) AS started_at FROM audit GROUP BY 1"""),
    Entry("retention_keep_n", "W10 J13", "symbol:s strategy:s executed_at:t n_bars:i", _retained,
          "SELECT symbol, strategy, executed_at, n_bars FROM runs"),
    Entry("retention_pruned", "W10", "n_pruned:i",
          lambda w: pruned_count(w.history, _retained(w)),
          "SELECT count(*) AS n_pruned FROM lat"),
    Entry("curve_cascade", "J14", "symbol:s strategy:s executed_at:t points:i",
          lambda w: _by_run(w, cascade(w.run_curve_rows, _retained(w))),
          """SELECT symbol, strategy, as_of AS executed_at, count(*) AS points
             FROM curve, clock GROUP BY ALL"""),
    Entry("run_writer", "S12", "symbol:s strategy:s executed_at:t points:i",
          lambda w: _by_run(w, w.run_curve_rows),
          """SELECT symbol, strategy, as_of - to_days(g) AS executed_at, count(*) AS points
             FROM curve, clock, (VALUES (0), (1)) t(g) GROUP BY ALL"""),
    Entry("legacy_components", "Q15", "symbol:s strategy:s executed_at:t components:a "
          "n_components:i", lambda w: backfill_components(w.history),
          """SELECT symbol, strategy, as_of - to_days(g) AS executed_at,
                    CASE WHEN g = 0 AND mask % 9 = 0 THEN [strategy] ELSE components END
                        AS components,
                    CASE WHEN g = 0 AND mask % 9 = 0 THEN 1 ELSE n_components END AS n_components
             FROM lat, clock, (VALUES (0), (1)) t(g)"""),
    Entry("configured_assets", "J16", "symbol:s strategy:s total_return:d5",
          lambda w: restrict(w.runs, w.catalog.where("region = 'latam'")),
          "SELECT symbol, strategy, total_return FROM runs WHERE symbol[1] IN ('2', '4')"),
    Entry("downsample_curve", "K4", "symbol:s strategy:s ts:t equity:d2", _thinned,
          """SELECT symbol, strategy, ts, round(equity, 2) AS equity
             FROM (SELECT *, count(*) OVER (PARTITION BY symbol, strategy) AS n FROM curve)
             WHERE rn IN (SELECT round_even(j * ((n - 1) / 399::DOUBLE), 0)::BIGINT
                          FROM range(0, 400) r(j)) OR n <= 400"""),
    Entry("split_boundary", "A17", "symbol:s split_ts:t", lambda w: split_boundary(w.runs),
          """SELECT symbol, split_ts FROM runs WHERE split_ts IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY strategy) = 1"""),
]


