"""Independent SQL formulations for the correctness check.

Each fragment is one common table expression; ``query`` collects the fragments a statement needs,
in order. Stateful results use recursive CTEs that walk bar by bar, so they can disagree with the
window and aggregate forms the library uses.
"""

from __future__ import annotations

import re

FRAGMENTS: dict[str, str] = {
    "bars": """
        SELECT o_orderpriority AS symbol, o_orderdate AS ts,
               arg_min(1000 + o_totalprice / 500, o_orderkey) AS open,
               max(1000 + o_totalprice / 500) AS high,
               min(1000 + o_totalprice / 500) AS low,
               arg_max(1000 + o_totalprice / 500, o_orderkey) AS close,
               CASE WHEN o_orderpriority <> '5-LOW' THEN count(*)::DOUBLE END AS volume,
               max(o_orderkey) AS k
        FROM orders GROUP BY 1, 2""",
    "catalog": """
        SELECT DISTINCT o_orderpriority AS symbol,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'crypto' WHEN '5-LOW' THEN 'fx'
                    ELSE 'equity' END AS asset_class,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'global' WHEN '3-MEDIUM' THEN 'us'
                    WHEN '5-LOW' THEN 'emerging' ELSE 'latam' END AS region,
               'Asset ' || o_orderpriority AS name,
               o_orderpriority <> '5-LOW' AS has_volume,
               CASE WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN '5-LOW' END
                   AS fx_pair
        FROM orders""",
    "clock": "SELECT max(o_orderdate) AS as_of FROM orders",
    "num": """
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS rn,
               count(*) OVER (PARTITION BY symbol) AS n,
               close - lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS delta
        FROM bars""",
    # --- bronze -------------------------------------------------------------------------------
    "typed": """
        SELECT 'coinbase' AS source, symbol, '1d' AS granularity, ts, open, high, low, close,
               coalesce(volume, k % 3)::DOUBLE AS volume, NULL::DOUBLE AS adj_close, k
        FROM bars WHERE k % 7 <> 0
        UNION ALL
        SELECT 'kraken', symbol, '1d', ts, open, high, low,
               close * (1 + (k % 17 - 8) * 0.0007::DOUBLE), coalesce(volume, k % 3)::DOUBLE,
               NULL, k FROM bars
        UNION ALL
        SELECT 'tiingo', symbol, '1d', ts, open, high, low, close,
               coalesce(volume, k % 3)::DOUBLE, close * 0.5::DOUBLE, k
        FROM bars WHERE k % 3 = 0 AND symbol NOT IN ('1-URGENT', '5-LOW')
        UNION ALL
        SELECT 'tiingo_fx', symbol, '1d', ts, open, high, low, close, NULL, NULL, k
        FROM bars WHERE k % 5 = 0 AND symbol = '5-LOW'""",
    "flagged": """
        SELECT *, coalesce(volume = 0, false) AS is_zero_volume,
               open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL AS has_null_price,
               coalesce(high < low, false) AS high_lt_low
        FROM typed""",
    "canon": """
        SELECT * FROM flagged
        QUALIFY row_number() OVER (PARTITION BY symbol, granularity, ts ORDER BY
            list_position(['coinbase', 'kraken', 'tiingo', 'tiingo_fx'], source)) = 1""",
    "recon": """
        SELECT a.symbol, a.ts, a.close AS coinbase_close, b.close AS kraken_close,
               abs(a.close - b.close) / nullif(a.close, 0) * 100 AS abs_pct_diff
        FROM typed a, typed b
        WHERE a.source = 'coinbase' AND b.source = 'kraken'
          AND a.symbol = b.symbol AND a.ts = b.ts""",
    "audit": """
        SELECT event_id AS ingest_run_id,
               ['coinbase', 'kraken', 'tiingo', 'tiingo_fx'][user_id % 4 + 1] AS source,
               event_type AS symbol, '1d' AS granularity, floor(value)::BIGINT AS rows_fetched,
               CASE WHEN event_type = 'error' THEN 0 ELSE floor(value)::BIGINT END
                   AS rows_inserted,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_type = 'error' THEN
                   'HTTPError: https://feed/x?token=' || sha256(event_id::VARCHAR) || '&n='
                   || event_id || ' API_KEY=' || user_id END AS error,
               ts AS started_at, ts + INTERVAL 2 SECOND AS finished_at,
               event_type = 'error' AND user_id % 5 = 0 AS rate_limited,
               event_type = 'error' AND user_id % 11 = 3 AS auth_failed
        FROM events""",
    # --- indicators ---------------------------------------------------------------------------
    "ind": """
        SELECT a.symbol, a.ts, a.open, a.high, a.low, a.close, a.volume,
               a.delta / nullif(a.close - a.delta, 0) AS daily_return,
               CASE WHEN rn >= 19 THEN avg(close) OVER w20 END AS sma_20,
               CASE WHEN rn >= 49 THEN avg(close) OVER w50 END AS sma_50,
               CASE WHEN rn >= 199 THEN avg(close) OVER w200 END AS sma_200,
               CASE WHEN rn >= 19 THEN avg(volume) OVER w20 END AS vol_sma_20,
               CASE WHEN rn >= 14 THEN
                   100 - 100 / (1 + sum(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER w14
                   / nullif(sum(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER w14, 0))
               END AS rsi_14,
               CASE WHEN rn >= 19 THEN stddev_pop(close) OVER w20 END AS dev_20
        FROM num a
        WINDOW w14 AS (PARTITION BY symbol ORDER BY rn ROWS 13 PRECEDING),
               w20 AS (PARTITION BY symbol ORDER BY rn ROWS 19 PRECEDING),
               w50 AS (PARTITION BY symbol ORDER BY rn ROWS 49 PRECEDING),
               w200 AS (PARTITION BY symbol ORDER BY rn ROWS 199 PRECEDING)""",
    # --- signals ------------------------------------------------------------------------------
    "frames": """
        SELECT symbol, ts, rn, n, open, high, low, close, volume,
               rn >= 49 AND avg(close) OVER w20 > avg(close) OVER w50 AS s_sma,
               rn >= 99 AND close > max(high) OVER w100
                   - (max(high) OVER w100 - min(low) OVER w100) * 0.618::DOUBLE AS s_fib,
               coalesce(rn >= 19 AND close > avg(close) OVER w20 AND count(volume) OVER w20 = 20
                   AND volume > 1.5::DOUBLE * avg(volume) OVER w20, false) AS s_vol,
               CASE WHEN rn >= 5 THEN
                   100 * sum(greatest(delta, 0)) OVER w5 / nullif(sum(abs(delta)) OVER w5, 0)
               END AS rsi
        FROM num
        WINDOW w5 AS (PARTITION BY symbol ORDER BY rn ROWS 4 PRECEDING),
               w20 AS (PARTITION BY symbol ORDER BY rn ROWS 19 PRECEDING),
               w50 AS (PARTITION BY symbol ORDER BY rn ROWS 49 PRECEDING),
               w100 AS (PARTITION BY symbol ORDER BY rn ROWS 99 PRECEDING)""",
    "walk": """
        SELECT symbol, rn, close AS e12, close AS e26, 0::DOUBLE AS line, 0 AS latched
        FROM frames WHERE rn = 0
        UNION ALL
        SELECT f.symbol, f.rn, w.e12 + (f.close - w.e12) * 2 / 13,
               w.e26 + (f.close - w.e26) * 2 / 27,
               w.line + ((w.e12 + (f.close - w.e12) * 2 / 13)
                         - (w.e26 + (f.close - w.e26) * 2 / 27) - w.line) * 2 / 10,
               CASE WHEN w.latched = 0 AND f.rsi < 40 THEN 1
                    WHEN w.latched = 1 AND f.rsi > 60 THEN 0 ELSE w.latched END
        FROM walk w JOIN frames f ON f.symbol = w.symbol AND f.rn = w.rn + 1""",
    "sig": """
        SELECT f.symbol, f.ts, f.rn, f.n, f.open, f.close, f.volume,
               s_fib::INT AS fibonacci, (e12 - e26 > line)::INT AS macd, latched AS rsi_reversion,
               s_sma::INT AS sma_cross, s_vol::INT AS volume_breakout,
               s_fib::INT + 2 * (e12 - e26 > line)::INT + 4 * latched + 8 * s_sma::INT
                   + 16 * s_vol::INT AS bits
        FROM frames f JOIN walk USING (symbol, rn)""",
    "averages": """
        SELECT symbol, rn, close AS e1, close AS e2 FROM num WHERE rn = 0
        UNION ALL
        SELECT f.symbol, f.rn, a.e1 + (f.close - a.e1) * 2 / 22,
               a.e2 + (a.e1 + (f.close - a.e1) * 2 / 22 - a.e2) * 2 / 22
        FROM averages a JOIN num f ON f.symbol = a.symbol AND f.rn = a.rn + 1""",
    # --- variants and windows -----------------------------------------------------------------
    "signal_list": """
        SELECT * FROM (VALUES (0, 'fibonacci', 100), (1, 'macd', 35), (2, 'rsi_reversion', 6),
                              (3, 'sma_cross', 50), (4, 'volume_breakout', 20)) t(bit, name, warm)
        """,
    "variant_list": """
        SELECT mask, list(name ORDER BY name) AS components, count(*) AS n_components,
               string_agg(name, '+' ORDER BY name) AS strategy, max(warm) AS warm
        FROM range(1, 32) r(mask), signal_list WHERE (mask >> bit) & 1 = 1 GROUP BY mask""",
    "lat": """
        SELECT b.symbol, b.n, c.asset_class, v.*, least(warm, n) AS start,
               least(warm, n) + round_even((n - least(warm, n)) * 0.7::DOUBLE, 0)::BIGINT AS split,
               CASE c.asset_class WHEN 'crypto' THEN 365 ELSE 252 END AS periods
        FROM (SELECT symbol, count(*) AS n, count_if(volume <> 0) AS live FROM bars GROUP BY 1) b
        JOIN catalog c USING (symbol), variant_list v
        WHERE v.mask < 16 OR (b.live > 0 AND c.asset_class <> 'fx')""",
    "win": """
        SELECT l.*, w AS "window", CASE w WHEN 'full' THEN 0 WHEN 'is' THEN start ELSE split END
                   AS lo,
               CASE w WHEN 'is' THEN split ELSE n END AS hi
        FROM lat l, (VALUES ('full'), ('is'), ('oos')) t(w)""",
    # Cash and units are walked one bar at a time for every variant and window.
    "sim": """
        SELECT symbol, mask, "window", lo AS rn, hi, 10000::DOUBLE AS cash, 0::DOUBLE AS units,
               0::DOUBLE AS cost, NULL::DOUBLE AS trade, false AS held
        FROM win WHERE hi > lo AND ("window" = 'full' OR hi - lo >= 30)
        UNION ALL
        SELECT p.symbol, p.mask, p."window", p.rn + 1, p.hi,
               CASE WHEN p.units = 0 AND go THEN 0
                    WHEN p.units > 0 AND NOT go THEN p.units * b.open * 0.9995 * 0.999
                    ELSE p.cash END,
               CASE WHEN p.units = 0 AND go THEN p.cash / (b.open * 1.0005 * 1.001)
                    WHEN p.units > 0 AND NOT go THEN 0 ELSE p.units END,
               CASE WHEN p.units = 0 AND go THEN p.cash ELSE p.cost END,
               CASE WHEN p.units > 0 AND NOT go
                    THEN p.units * b.open * 0.9995 * 0.999 / p.cost - 1 END,
               go
        FROM sim p JOIN sig a ON a.symbol = p.symbol AND a.rn = p.rn
        JOIN sig b ON b.symbol = p.symbol AND b.rn = p.rn + 1,
        LATERAL (SELECT a.bits & p.mask = p.mask AS go) g
        WHERE p.rn + 1 < p.hi""",
    "marked": """
        SELECT s.symbol, s.mask, s."window", s.rn, b.ts, cash + units * b.close AS equity, held,
               trade
        FROM sim s JOIN sig b USING (symbol, rn)""",
    "steps": """
        SELECT *, equity / lag(equity) OVER w - 1 AS r,
               equity / max(equity) OVER w - 1 AS dd
        FROM marked WINDOW w AS (PARTITION BY symbol, mask, "window" ORDER BY rn)""",
    "scored": """
        SELECT symbol, mask, "window", count(*) AS bars, arg_max(equity, rn) / 10000 - 1
                   AS total_return,
               min(dd) AS max_drawdown, count(trade) AS n_trades,
               count_if(trade > 0) / nullif(count(trade), 0)::DOUBLE AS win_rate,
               count_if(held) / count(*)::DOUBLE AS exposure,
               CASE WHEN count(r) >= 2 AND count_if(r <> 0) >= 2
                     AND NOT (count(r) >= 30 AND count_if(r <> 0) < 5)
                    THEN avg(r) / nullif(stddev_samp(r), 0) END AS raw_sharpe
        FROM steps GROUP BY ALL""",
    "hold": """
        SELECT w.symbol, w.mask, w."window", z.close / (a.open * 1.0005 * 1.001) - 1
                   AS buy_hold_return
        FROM win w JOIN sig a ON a.symbol = w.symbol AND a.rn = w.lo
        JOIN sig z ON z.symbol = w.symbol AND z.rn = w.hi - 1""",
    "met": """
        SELECT w.symbol, w.asset_class, w.mask, w.strategy, w.components, w.n_components, w.n,
               w."window", hi - lo AS bars, total_return,
               pow(1 + total_return, periods / (hi - lo)::DOUBLE) - 1 AS cagr,
               CASE WHEN s.bars IS NOT NULL THEN buy_hold_return END AS buy_hold_return,
               max_drawdown, raw_sharpe * sqrt(periods) AS sharpe, n_trades, win_rate, exposure,
               w.split
        FROM win w LEFT JOIN scored s USING (symbol, mask, "window")
        LEFT JOIN hold USING (symbol, mask, "window")""",
    "runs": """
        SELECT f.symbol, f.mask, f.strategy, f.components, f.n_components, f.n AS n_bars,
               CASE f.n_components WHEN 1 THEN 'single' ELSE 'combo' END AS strategy_kind,
               f.n_components = 1 AS has_curve, c.as_of AS executed_at,
               (SELECT ts FROM num WHERE num.symbol = f.symbol AND num.rn = f.split) AS split_ts,
               f.total_return, f.cagr, f.buy_hold_return, f.max_drawdown, f.sharpe, f.n_trades,
               f.win_rate, f.exposure,
               i.total_return AS is_total_return, i.buy_hold_return AS is_buy_hold_return,
               i.sharpe AS is_sharpe, i.max_drawdown AS is_max_drawdown, i.n_trades AS is_n_trades,
               i.exposure AS is_exposure,
               o.total_return AS oos_total_return, o.buy_hold_return AS oos_buy_hold_return,
               o.sharpe AS oos_sharpe, o.max_drawdown AS oos_max_drawdown,
               o.n_trades AS oos_n_trades, o.exposure AS oos_exposure
        FROM met f JOIN met i ON i.symbol = f.symbol AND i.mask = f.mask AND i."window" = 'is'
        JOIN met o ON o.symbol = f.symbol AND o.mask = f.mask AND o."window" = 'oos', clock c
        WHERE f."window" = 'full'""",
    # Latest generation as stored: some variants unscored, some with legacy component lists.
    "latest": """
        SELECT symbol, mask, strategy, strategy_kind, n_components, n_bars, has_curve, executed_at,
               split_ts, components, exposure, total_return, cagr, buy_hold_return, sharpe,
               max_drawdown, win_rate,
               CASE WHEN mask % 7 <> 0 THEN n_trades END AS n_trades,
               CASE WHEN mask % 7 <> 0 THEN is_total_return END AS is_total_return,
               CASE WHEN mask % 7 <> 0 THEN is_buy_hold_return END AS is_buy_hold_return,
               CASE WHEN mask % 7 <> 0 THEN is_sharpe END AS is_sharpe,
               CASE WHEN mask % 7 <> 0 THEN is_max_drawdown END AS is_max_drawdown,
               CASE WHEN mask % 7 <> 0 THEN is_n_trades END AS is_n_trades,
               CASE WHEN mask % 7 <> 0 THEN is_exposure END AS is_exposure,
               CASE WHEN mask % 7 <> 0 THEN oos_total_return END AS oos_total_return,
               CASE WHEN mask % 7 <> 0 THEN oos_buy_hold_return END AS oos_buy_hold_return,
               CASE WHEN mask % 7 <> 0 THEN oos_sharpe END AS oos_sharpe,
               CASE WHEN mask % 7 <> 0 THEN oos_max_drawdown END AS oos_max_drawdown,
               CASE WHEN mask % 7 <> 0 THEN oos_n_trades END AS oos_n_trades,
               CASE WHEN mask % 7 <> 0 THEN oos_exposure END AS oos_exposure
        FROM runs""",
    "variants": """
        SELECT l.*, c.asset_class, c.region,
               total_return - buy_hold_return AS excess_return,
               is_total_return - is_buy_hold_return AS is_excess_return,
               oos_total_return - oos_buy_hold_return AS oos_excess_return,
               is_total_return - is_buy_hold_return - (oos_total_return - oos_buy_hold_return)
                   AS oos_excess_drop,
               total_return > buy_hold_return AND coalesce(n_trades, 0) > 0 AS beat_bh_full,
               is_total_return > is_buy_hold_return AND coalesce(is_n_trades, 0) > 0
                   AS beat_bh_is,
               oos_total_return > oos_buy_hold_return AND coalesce(oos_n_trades, 0) > 0
                   AS beat_bh_oos
        FROM latest l JOIN catalog c USING (symbol)""",
    "curve": """
        SELECT m.symbol, v.strategy, m.ts, m.rn, m.held, m.equity,
               10000 * b.close / (first_value(b.open) OVER (PARTITION BY m.symbol, m.mask
                   ORDER BY m.rn) * 1.0005 * 1.001) AS buy_hold_equity
        FROM marked m JOIN variant_list v USING (mask) JOIN sig b USING (symbol, rn)
        WHERE m."window" = 'full' AND v.n_components = 1""",
    "trips": """
        SELECT s.symbol, s.mask, s."window", s.rn, s.trade, s.held,
               count_if(s.held AND NOT coalesce(p.held, false)) OVER
                   (PARTITION BY s.symbol, s.mask, s."window" ORDER BY s.rn) AS trip,
               s.held AND NOT coalesce(p.held, false) AS opens
        FROM sim s LEFT JOIN sim p ON p.symbol = s.symbol AND p.mask = s.mask
             AND p."window" = s."window" AND p.rn = s.rn - 1""",
    "summary": """
        WITH e AS (SELECT symbol, max(ts) AS end_ts, arg_max(close, ts) AS end_close
                   FROM bars GROUP BY 1)
        SELECT e.symbol, c.asset_class, c.region, e.end_close AS latest_close,
               e.end_close / nullif((SELECT b.close FROM bars b WHERE b.symbol = e.symbol
                   AND b.ts <= e.end_ts - INTERVAL 30 DAY ORDER BY b.ts DESC LIMIT 1), 0) - 1
                   AS return_30d,
               (SELECT stddev_samp(i.daily_return) FROM ind i WHERE i.symbol = e.symbol
                   AND i.ts > e.end_ts - INTERVAL 30 DAY)
                   * sqrt(CASE c.asset_class WHEN 'crypto' THEN 365 ELSE 252 END)
                   AS volatility_30d,
               e.end_ts AS last_candle_ts,
               (SELECT as_of FROM clock) - e.end_ts > INTERVAL 3 DAY AS is_stale
        FROM e JOIN catalog c USING (symbol)""",
    "quality": """
        WITH d AS (SELECT symbol, ts, ts::DATE AS day, has_null_price, is_zero_volume,
                          date_diff('day', lag(ts) OVER (PARTITION BY symbol ORDER BY ts), ts)
                              AS gap
                   FROM canon),
        s AS (SELECT symbol, min(ts) AS first_ts, max(ts) AS last_ts, min(day) AS lo,
                     max(day) AS hi, count(*) AS actual_days, max(gap) AS gap,
                     count_if(has_null_price) AS n_null_price,
                     count_if(is_zero_volume) AS n_zero_volume
              FROM d GROUP BY 1)
        SELECT s.symbol, c.asset_class, c.region, first_ts, last_ts, actual_days,
               (SELECT count(*) FROM range(0, date_diff('day', lo, hi) + 1) r(i)
                WHERE c.asset_class = 'crypto' OR isodow(lo + i::INT) < 6) AS expected_days,
               coalesce(gap, 0) AS max_gap_days, n_null_price, n_zero_volume
        FROM s JOIN catalog c USING (symbol)""",
    "starts": """
        SELECT e.symbol, w.label, CASE WHEN days IS NULL THEN e.lo ELSE b.ts END AS start_ts,
               CASE WHEN days IS NULL THEN e.lo_close ELSE b.close END AS start_close,
               e.hi AS end_ts, e.hi_close AS end_close
        FROM (SELECT symbol, min(ts) AS lo, arg_min(close, ts) AS lo_close, max(ts) AS hi,
                     arg_max(close, ts) AS hi_close FROM bars GROUP BY 1) e
        CROSS JOIN (VALUES ('30d', 30), ('90d', 90), ('365d', 365), ('full', NULL)) w(label, days)
        ASOF LEFT JOIN bars b
            ON b.symbol = e.symbol AND b.ts <= e.hi - to_days(coalesce(w.days, 0))""",
    "fx": """
        SELECT c.symbol, c.region, c.fx_pair, a.label AS window_label,
               a.end_close / nullif(a.start_close, 0) - 1 AS usd_return,
               f.end_close / nullif(f.start_close, 0) - 1 AS fx_return,
               a.end_close / nullif(a.start_close, 0) * f.end_close / nullif(f.start_close, 0) - 1
                   AS local_return,
               a.start_ts AS adr_start_ts, a.end_ts AS adr_end_ts, f.start_ts AS fx_start_ts,
               f.end_ts AS fx_end_ts
        FROM catalog c JOIN starts a ON a.symbol = c.symbol
        LEFT JOIN starts f ON f.symbol = c.fx_pair AND f.label = a.label
        WHERE c.fx_pair IS NOT NULL""",
    "board": """
        SELECT strategy, strategy_kind, n_components,
               CASE WHEN total THEN 'ALL' ELSE asset_class END AS asset_class,
               CASE WHEN total THEN 'ALL' ELSE region END AS region, total AS is_grand_total,
               count(*) AS n_backtests, count_if(beat_bh_full) AS n_beat_buy_hold,
               avg(beat_bh_full::INT) AS beat_rate,
               avg(total_return) AS avg_total_return, avg(buy_hold_return) AS avg_buy_hold_return,
               avg(excess_return) AS avg_excess_return, median(sharpe) AS median_sharpe,
               avg(max_drawdown) AS avg_max_drawdown, avg(n_trades) AS avg_n_trades,
               avg(exposure) AS avg_exposure, avg(is_excess_return) AS avg_is_excess_return,
               avg(oos_excess_return) AS avg_oos_excess_return,
               count_if(beat_bh_is) AS n_beat_is,
               count_if(beat_bh_is AND oos_excess_return IS NOT NULL) AS n_beat_is_scored_oos,
               count_if(beat_bh_is AND beat_bh_oos) AS n_beat_is_and_oos,
               count_if(beat_bh_is AND beat_bh_oos)::DOUBLE / nullif(count_if(beat_bh_is
                   AND oos_excess_return IS NOT NULL), 0) AS oos_survival_rate
        FROM variants, (VALUES (false), (true)) t(total) GROUP BY ALL""",
    "overfit": """
        SELECT total AS is_grand_total, CASE WHEN NOT total THEN n_components END AS n_components,
               count(*) AS n_variants, count(excess_return) AS n_evaluated_full,
               count(is_excess_return) AS n_evaluated_is,
               count(oos_excess_return) AS n_evaluated_oos,
               count(oos_excess_drop) AS n_evaluated_both,
               count_if(beat_bh_full) AS n_beat_full, count_if(beat_bh_is) AS n_beat_is,
               count_if(beat_bh_is AND oos_excess_return IS NOT NULL) AS n_beat_is_scored_oos,
               count_if(beat_bh_oos) AS n_beat_oos,
               count_if(beat_bh_is AND beat_bh_oos) AS n_beat_is_and_oos,
               count_if(beat_bh_full)::DOUBLE / nullif(count(excess_return), 0)
                   AS share_beat_full,
               count_if(beat_bh_is)::DOUBLE / nullif(count(is_excess_return), 0) AS share_beat_is,
               count_if(beat_bh_oos)::DOUBLE / nullif(count(oos_excess_return), 0)
                   AS share_beat_oos,
               count_if(beat_bh_is AND beat_bh_oos)::DOUBLE / nullif(count(oos_excess_drop), 0)
                   AS share_beat_is_and_oos,
               count_if(beat_bh_is AND beat_bh_oos)::DOUBLE / nullif(count_if(beat_bh_is
                   AND oos_excess_return IS NOT NULL), 0) AS oos_survival_rate,
               avg(exposure) AS avg_exposure, avg(excess_return) AS avg_excess_return,
               avg(is_excess_return) AS avg_is_excess_return,
               avg(oos_excess_return) AS avg_oos_excess_return,
               avg(oos_excess_drop) AS avg_oos_excess_drop
        FROM variants, (VALUES (false), (true)) t(total)
        GROUP BY total, CASE WHEN NOT total THEN n_components END""",
}


RECURSIVE = ("walk", "sim", "averages")


def _needs(sql: str) -> list[str]:
    """Fragments named after FROM, JOIN or a comma of a FROM list."""
    words = set(re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", sql))
    return [name for name in FRAGMENTS if name in words]


def query(sql: str, **replaced: str) -> str:
    """``sql`` preceded by the fragments it refers to, directly or through other fragments.

    Keyword arguments replace fragments, to run the same statement over other bars.
    """
    fragments = {**FRAGMENTS, **replaced}
    wanted: set[str] = set()
    queue = _needs(sql)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += _needs(fragments[name])
    if not wanted:
        return sql
    parts = [
        f"{name} AS {'' if name in RECURSIVE else 'MATERIALIZED '}({fragments[name]})"
        for name in fragments
        if name in wanted
    ]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql
