"""Registered queries: marts, publishing, expectations, dashboard measures."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.functions.ranking import exact_median
from tickloom.operators import expectations as q
from tickloom.plans import marts, measures
from tickloom.registry.adapters import Warehouse
from tickloom.registry.analytics import _by_run
from tickloom.registry.spec import Entry
from tickloom.session import fresh_path, materialise
from tickloom.sources import json_sinks as sinks


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _summary(w: Warehouse) -> DataFrame:
    return marts.asset_summary(w.indicator_rows, w.catalog, F.lit(w.as_of))


def _quality(w: Warehouse) -> DataFrame:
    return marts.data_quality(w.canonical, w.catalog)


def _medians(w: Warehouse) -> DataFrame:
    """Closes and daily returns by region, the latter close together and searched in rounds."""
    def by_region(df: DataFrame, value: str, **options: int) -> DataFrame:
        return exact_median(df.join(w.catalog, "symbol"), ["region"], value, **options)

    returns = by_region(w.indicator_rows, "daily_return", limit=100, pivots=8)
    return by_region(w.canonical, "close").join(
        returns.withColumnRenamed("median", "median_return"), "region"
    )


def _entries(w: Warehouse) -> DataFrame:
    return sinks.variant_entries(w.variant_mart)


#: In the catalog, but without a single bar.
WAITING = "6-NO DATA"


def _catalog_with_waiting(w: Warehouse) -> DataFrame:
    """The catalog and one more asset that no mart has a row for."""
    one = w.catalog.limit(1).select(
        F.lit(WAITING).alias("symbol"), F.lit("equity").alias("asset_class"),
        F.lit("global").alias("region"), F.lit("Asset 6").alias("name"),
        F.lit(True).alias("has_volume"), F.lit("5-LOW").alias("fx_pair"),
    )
    return w.catalog.unionByName(one)


def _index(w: Warehouse) -> DataFrame:
    docs = sinks.asset_documents(
        _catalog_with_waiting(w), F.lit(w.as_of), summary=_summary(w), quality=_quality(w),
        reconciliation=marts.reconciliation_rollup(w.reconciliation),
        runs=marts.latest_runs(w.history), variants=w.variant_mart,
    )
    d = F.col("document")
    return docs.select(
        "symbol",
        F.get_json_object(d, "$.fx_pair").alias("fx_pair"),
        F.get_json_object(d, "$.summary.latest_close").alias("latest_close"),
        F.get_json_object(d, "$.data_quality.actual_days").alias("actual_days"),
        F.get_json_object(d, "$.reconciliation.n_discrepant").alias("n_discrepant"),
        F.json_array_length(F.get_json_object(d, "$.strategies")).alias("n_strategies"),
        F.json_array_length(F.get_json_object(d, "$.combinations")).alias("n_listed"),
        F.get_json_object(d, "$.n_combinations").alias("n_combinations"),
        F.get_json_object(d, "$.combinations[0].strategy").alias("first_variant"),
    )


def _sections(w: Warehouse) -> DataFrame:
    """The whole index, written by section and read again."""
    path = fresh_path(w.spark, "index-sections")
    sections = sinks.index_sections(
        w.catalog, F.lit(w.as_of), summary=_summary(w), quality=_quality(w),
        reconciliation=marts.reconciliation_rollup(w.reconciliation),
        runs=marts.latest_runs(w.history), variants=w.variant_mart,
        overfitting=marts.overfitting_summary(w.variant_mart),
        leaderboard=marts.strategy_leaderboard(w.variant_mart), fx_decomposition=w.fx_mart,
        totals=marts.totals(w.raw, w.history), recent_ingest_runs=w.audit,
    )
    sinks.write_index(sections, path)
    return w.spark.read.schema("value string, section string").text(path)


def _section(w: Warehouse, name: str, **fields: str) -> DataFrame:
    """Fields of a section's documents by JSON path."""
    rows = w.index_rows.where(F.col("section") == name)
    return rows.select(*[F.get_json_object("value", f"$.{p}").alias(c) for c, p in fields.items()])


def _tolerant(w: Warehouse) -> DataFrame:
    """Sections of an index for which most marts are absent."""
    sections = sinks.index_sections(
        w.catalog, F.lit(w.as_of), runs=marts.latest_runs(w.history), totals=marts.totals(w.raw, w.history)
    )
    listed = sections.where("section = 'assets'").select(
        F.lit("assets").alias("name"), F.lit(True).alias("present"),
        F.json_array_length(F.get_json_object("document", "$.combinations")).alias("n"),
        F.get_json_object("document", "$.summary").isNull().alias("no_summary"),
    )
    contents = sections.where("section = 'contents'").select(
        F.col("key").alias("name"), F.get_json_object("document", "$.present").cast("boolean").alias("present"),
        F.lit(0).alias("n"), F.lit(True).alias("no_summary"),
    )
    return listed.unionByName(contents.where("name <> 'assets'")).groupBy("name", "present").agg(
        F.sum("n").alias("n_listed"), F.bool_and("no_summary").alias("no_summary")
    )


def _budget(w: Warehouse) -> DataFrame:
    """The same whole index under the standing budget and under one it cannot meet."""
    docs = sinks.asset_documents(
        w.catalog, F.lit(w.as_of), summary=_summary(w), quality=_quality(w),
        reconciliation=marts.reconciliation_rollup(w.reconciliation),
        runs=marts.latest_runs(w.history), variants=w.variant_mart,
    )
    docs = materialise(docs, "index")
    return _union(
        *[sinks.index_size_report(docs, b) for b in (sinks.INDEX_BYTE_BUDGET, 1_000)]
    )


def _documents(w: Warehouse) -> DataFrame:
    latest = marts.latest_runs(w.history)
    return sinks.symbol_documents(
        w.catalog, latest, w.single_curves, _entries(w), F.lit(w.as_of)
    )


def _curves(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "curves")
    sinks.write_curves(w.single_curves, path)
    return w.spark.read.parquet(path).groupBy("symbol", "strategy").agg(
        F.count(F.lit(1)).alias("points"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def _document_fields(w: Warehouse) -> DataFrame:
    d = F.col("document")
    return _documents(w).select(
        "symbol",
        F.get_json_object(d, "$.split_ts").alias("split_ts"),
        F.json_array_length(F.get_json_object(d, "$.backtests")).alias("n_backtests"),
        F.json_array_length(F.get_json_object(d, "$.combinations")).alias("n_combinations"),
        F.get_json_object(d, "$.backtests[0].curve_points").alias("points"),
        F.get_json_object(d, "$.backtests[0].metrics.n_bars").alias("n_bars"),
        F.get_json_object(d, "$.backtests[0].metrics.total_return").alias("total_return"),
    )


def _pruned_files(w: Warehouse) -> DataFrame:
    """Write every asset, then all but the currency; the stale folder must be gone."""
    path = fresh_path(w.spark, "per-symbol")
    docs = w.catalog.select("symbol", scalars.as_json("symbol", "region").alias("document"))
    sinks.write_symbols(docs, path)
    sinks.write_symbols(docs.where("symbol <> '5-LOW'"), path)
    return w.spark.read.text(path).select(
        "symbol", F.get_json_object("value", "$.region").alias("region")
    )


def _rounded(w: Warehouse) -> DataFrame:
    return w.reconciliation.select(
        "symbol", "ts", scalars.half_even(F.col("kraken_close"), 2).alias("price"),
        scalars.half_even(F.col("abs_pct_diff"), 4).alias("gap"),
    )


def _split_summary(w: Warehouse) -> DataFrame:
    detail, overall = marts.split_overall(marts.overfitting_summary(w.variant_mart))
    return detail.withColumn("part", F.lit("by_n_components")).unionByName(
        overall.withColumn("part", F.lit("overall"))
    )


# --- expectations --------------------------------------------------------------------------
SOURCES = ["coinbase", "kraken", "tiingo", "tiingo_fx"]


def _typed_report(w: Warehouse) -> DataFrame:
    rules = {f"not_null({c})": q.not_null(c) for c in
             ("source", "symbol", "ts", "open", "high", "low", "close")}
    rules["not_null(volume)"] = q.not_null("volume", F.col("source") != "tiingo_fx")
    rules["not_null(volume, all)"] = q.not_null("volume")
    rules["accepted(source)"] = q.accepted("source", SOURCES)
    rules["accepted(source, crypto)"] = q.accepted("source", SOURCES[:2])
    rules["ohlc"] = q.ohlc_inconsistent()
    canonical = {"not_null(symbol)": q.not_null("symbol"), "ohlc": q.ohlc_inconsistent()}
    return _union(
        q.row_rules(w.typed, "stg_ohlcv_all_sources", rules),
        q.row_rules(w.canonical, "stg_ohlcv", canonical),
        q.unique(w.canonical, "stg_ohlcv", ["symbol", "granularity", "ts"]),
        q.unique(w.typed, "stg_ohlcv_all_sources", ["symbol", "granularity", "ts"]),
        q.relationship(w.canonical, "stg_ohlcv", "symbol", w.catalog, "symbol"),
        q.relationship(w.canonical, "stg_ohlcv", "symbol",
                       w.catalog.where("asset_class <> 'fx'"), "symbol", q.WARN),
        q.relationship(w.catalog, "dim_assets", "fx_pair", w.catalog, "symbol"),
        q.discrepancy_warning(marts.discrepancy_rate(w.reconciliation)),
    )


TYPED_REPORT_SQL = """
    SELECT unnest([
      {'expectation': 'not_null(source)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': 0},
      {'expectation': 'not_null(symbol)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': 0},
      {'expectation': 'not_null(ts)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': 0},
      {'expectation': 'not_null(open)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(open IS NULL)},
      {'expectation': 'not_null(high)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(high IS NULL)},
      {'expectation': 'not_null(low)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(low IS NULL)},
      {'expectation': 'not_null(close)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(close IS NULL)},
      {'expectation': 'not_null(volume)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(volume IS NULL AND source <> 'tiingo_fx')},
      {'expectation': 'not_null(volume, all)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(volume IS NULL)},
      {'expectation': 'accepted(source)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': 0},
      {'expectation': 'accepted(source, crypto)', 'relation': 'stg_ohlcv_all_sources',
       'severity': 'error', 'n_failed': count_if(source LIKE 'tiingo%')},
      {'expectation': 'ohlc', 'relation': 'stg_ohlcv_all_sources', 'severity': 'error',
       'n_failed': count_if(high < low OR close NOT BETWEEN low AND high)}], recursive := true)
    FROM typed
    UNION ALL SELECT 'not_null(symbol)', 'stg_ohlcv', 'error', count_if(symbol IS NULL) FROM canon
    UNION ALL SELECT 'ohlc', 'stg_ohlcv', 'error',
        count_if(high < low OR close NOT BETWEEN low AND high) FROM canon
    UNION ALL SELECT 'unique(symbol,granularity,ts)', 'stg_ohlcv', 'error', 0
    UNION ALL SELECT 'unique(symbol,granularity,ts)', 'stg_ohlcv_all_sources', 'error', count(*)
        FROM (SELECT 1 FROM typed GROUP BY symbol, ts HAVING count(*) > 1)
    UNION ALL SELECT 'relationship(symbol)', 'stg_ohlcv', 'error', 0
    UNION ALL SELECT 'relationship(symbol)', 'stg_ohlcv', 'warn', count_if(symbol = '5-LOW')
        FROM canon
    UNION ALL SELECT 'relationship(fx_pair)', 'dim_assets', 'error', 0
    UNION ALL SELECT 'discrepancy_rate', 'mart_source_reconciliation', 'warn',
        (count_if(abs_pct_diff > 0.5) >= 0.1 * count(*))::INT FROM recon
"""


def _run_report(w: Warehouse) -> DataFrame:
    board = marts.strategy_leaderboard(w.variant_mart)
    violations = q.survival_violations(board, marts.overfitting_summary(w.variant_mart))
    survival = violations.agg(F.count(F.lit(1)).alias("n_failed")).select(
        F.lit("survival").alias("expectation"), F.lit("marts").alias("relation"),
        F.lit(q.ERROR).alias("severity"), "n_failed",
    )
    return _union(
        q.row_rules(w.variant_mart, "mart_combination_analysis", {
            "naming": q.naming_broken(),
            "exposure": q.in_range("exposure", 0, 1),
            "exposure below half": q.in_range("exposure", 0, 0.5),
        }),
        q.row_rules(w.fx_mart, "mart_fx_decomposition", {"identity": q.fx_identity_broken()}),
        q.row_rules(board, "mart_strategy_leaderboard",
                    {"beat_rate": q.in_range("beat_rate", 0, 1),
                     "beat_rate below half": q.in_range("beat_rate", 0, 0.49)}),
        q.row_rules(w.history, "backtest_runs", q.run_constraints()),
        q.row_rules(w.audit, "ingest_runs", q.audit_constraints()),
        survival,
    )


def _violations(w: Warehouse) -> DataFrame:
    """The rules over marts whose rates were scaled out of range for the larger sizes."""
    board = marts.strategy_leaderboard(w.variant_mart).withColumn(
        "oos_survival_rate", F.col("oos_survival_rate") * F.col("n_components")
    )
    summary = marts.overfitting_summary(w.variant_mart).withColumn(
        "share_beat_is", F.col("share_beat_is") * 3
    )
    return q.survival_violations(board, summary)


def _gate_input(w: Warehouse) -> DataFrame:
    """Indicator rows with two damaged symbols."""
    k = F.unix_date(F.to_date("ts"))
    return (
        w.indicator_rows.withColumn(
            "open", F.when((F.col("symbol") == "2-HIGH") & (k % 50 == 0), F.lit(-1.0)).otherwise(
                F.col("open"))
        )
        .withColumn("volume", F.when((F.col("symbol") == "3-MEDIUM") & (k % 90 == 0), F.lit(None))
                    .otherwise(F.col("volume")))
    )


def _gate(w: Warehouse) -> DataFrame:
    return q.input_gate(_gate_input(w), w.catalog)


def _freshness(w: Warehouse) -> DataFrame:
    newest = w.audit.agg(F.max("finished_at")).first()[0]
    return _union(*[
        q.freshness(w.audit, "finished_at", F.lit(newest + dt.timedelta(hours=h)), name)
        for h, name in ((10, "after 10 h"), (40, "after 40 h"), (80, "after 80 h"))
    ])


GATE_SQL = """
    SELECT symbol, 0 AS repeated_ts,
           count_if(symbol = '2-HIGH' AND d % 50 = 0) AS bad_price,
           count_if(symbol = '3-MEDIUM' AND d % 90 = 0) AS bad_volume,
           count_if(symbol = '2-HIGH' AND d % 50 = 0) AS bad_shape, 0 AS bad_rsi
    FROM (SELECT symbol, date_diff('day', DATE '1970-01-01', ts) AS d FROM bars) GROUP BY symbol
"""

REPORT = "expectation:s relation:s severity:s n_failed:i"
VARIANT = (
    "symbol:s asset_class:s region:s strategy:s strategy_kind:s n_components:i components:a "
    "has_curve:b executed_at:t n_bars:i split_ts:t exposure:d6 total_return:d5 "
    "buy_hold_return:d6 excess_return:d5 sharpe:d6 max_drawdown:d6 n_trades:i "
    "is_total_return:d5 is_buy_hold_return:d6 is_excess_return:d5 is_sharpe:d6 "
    "is_max_drawdown:d6 is_n_trades:i oos_total_return:d5 oos_buy_hold_return:d6 "
    "oos_excess_return:d5 oos_sharpe:d6 oos_max_drawdown:d6 oos_n_trades:i is_exposure:d6 "
    "oos_exposure:d6 oos_excess_drop:d5 beat_bh_full:b beat_bh_is:b beat_bh_oos:b"
)
BOARD = (
    "strategy:s strategy_kind:s n_components:i asset_class:s region:s is_grand_total:b "
    "n_backtests:i n_beat_buy_hold:i beat_rate:d6 avg_total_return:d5 avg_buy_hold_return:d6 "
    "avg_excess_return:d5 median_sharpe:d6 avg_max_drawdown:d6 avg_n_trades:d6 avg_exposure:d6 "
    "avg_is_excess_return:d5 avg_oos_excess_return:d5 n_beat_is:i n_beat_is_scored_oos:i "
    "n_beat_is_and_oos:i oos_survival_rate:d6"
)
OVERFIT = (
    "is_grand_total:b n_components:i n_variants:i n_evaluated_full:i n_evaluated_is:i "
    "n_evaluated_oos:i n_evaluated_both:i n_beat_full:i n_beat_is:i n_beat_is_scored_oos:i "
    "n_beat_oos:i n_beat_is_and_oos:i share_beat_full:d6 share_beat_is:d6 share_beat_oos:d6 "
    "share_beat_is_and_oos:d6 oos_survival_rate:d6 avg_exposure:d6 avg_excess_return:d5 "
    "avg_is_excess_return:d5 avg_oos_excess_return:d5 avg_oos_excess_drop:d5"
)
FX = (
    "symbol:s region:s fx_pair:s window_label:s usd_return:d6 fx_return:d6 local_return:d6 "
    "fx_drag_pp:d6 adr_start_ts:t adr_end_ts:t fx_start_ts:t fx_end_ts:t"
)
FX_SQL = "SELECT *, usd_return - local_return AS fx_drag_pp FROM fx"
RANKED_SQL = """
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round_even(oos_excess_return, 6)
        DESC NULLS LAST, n_components, strategy) AS place FROM variants
"""

ENTRIES = [
    Entry("source_reconciliation", "J1 P12 M4",
          "symbol:s ts:t coinbase_close:d6 kraken_close:d9 abs_pct_diff:d6 is_discrepant:b",
          lambda w: w.reconciliation,
          "SELECT *, coalesce(abs_pct_diff > 0.5, false) AS is_discrepant FROM recon"),
    Entry("reconciliation_rollup", "A11", "symbol:s n_discrepant:i max_abs_pct_diff:d6",
          lambda w: marts.reconciliation_rollup(w.reconciliation),
          """SELECT symbol, count_if(abs_pct_diff > 0.5) AS n_discrepant,
                    max(abs_pct_diff) AS max_abs_pct_diff FROM recon GROUP BY 1"""),
    Entry("discrepancy_rate", "A13", "discrepant_rate:d8",
          lambda w: marts.discrepancy_rate(w.reconciliation),
          "SELECT avg((abs_pct_diff > 0.5)::INT) AS discrepant_rate FROM recon"),
    Entry("data_quality", "A1 A2 A3 J2 J3 J9 M5",
          "symbol:s asset_class:s region:s first_ts:t last_ts:t expected_days:i actual_days:i "
          "missing_days:i max_gap_days:i n_null_price:i n_zero_volume:i", _quality,
          "SELECT *, expected_days - actual_days AS missing_days FROM quality"),
    Entry("asset_summary", "W8 J3 J5 J6 A4 P8 P9 P10 M6",
          "symbol:s asset_class:s region:s latest_close:d6 return_30d:d6 volatility_30d:d6 "
          "last_candle_ts:t is_stale:b", _summary, "SELECT * FROM summary"),
    Entry("staleness", "P9", "symbol:s is_stale:b",
          lambda w: marts.asset_summary(
              w.indicator_rows, w.catalog, F.lit(w.as_of + dt.timedelta(hours=71))),
          """SELECT symbol, max(ts) < (SELECT as_of FROM clock) - INTERVAL 1 HOUR AS is_stale
             FROM bars GROUP BY 1"""),
    Entry("asof_lookback", "J5 U1", "symbol:s window_label:s start_ts:t start_close:d6",
          lambda w: marts.lookback_starts(w.bars, marts.ends(w.bars)),
          "SELECT symbol, label AS window_label, start_ts, start_close FROM starts"),
    Entry("fx_decomposition", "J4 J7 J8 P10 P11 M7", FX, lambda w: w.fx_mart, FX_SQL),
    Entry("label_order", "P20", "symbol:s window_label:s place:i",
          lambda w: w.fx_mart.withColumn("place", scalars.label_rank(F.col("window_label"))),
          """SELECT symbol, window_label, CASE window_label WHEN '30d' THEN 1 WHEN '90d' THEN 2
                    WHEN '365d' THEN 3 ELSE 4 END AS place FROM fx"""),
    Entry("combination_analysis", "W8 J2 P13 P14 P15 M8", VARIANT,
          lambda w: marts.combination_analysis(w.history, w.catalog), "SELECT * FROM variants"),
    Entry("leaderboard", "A5 A7 A9 A10 P21 K5 M9", BOARD,
          lambda w: measures.leaderboard_order(marts.strategy_leaderboard(w.variant_mart)),
          "SELECT * FROM board"),
    Entry("overfitting_summary", "A6 A7 A8 A10 M10", OVERFIT,
          lambda w: marts.overfitting_summary(w.variant_mart), "SELECT * FROM overfit"),
    Entry("overfitting_split", "A16", "part:s n_components:i n_variants:i oos_survival_rate:d6",
          _split_summary,
          """SELECT CASE WHEN is_grand_total THEN 'overall' ELSE 'by_n_components' END AS part,
                    n_components, n_variants, oos_survival_rate FROM overfit"""),
    Entry("exact_median", "A9", "region:s median:d6 median_return:d9", _medians,
          """SELECT region, median, median_return FROM (
                 SELECT region, median(close) AS median FROM canon JOIN catalog USING (symbol)
                 GROUP BY 1) JOIN (
                 SELECT region, median(daily_return) AS median_return
                 FROM ind JOIN catalog USING (symbol) GROUP BY 1) USING (region)"""),
    Entry("totals", "A12", "assets:i bronze_rows:i sources:i backtests:i",
          lambda w: marts.totals(w.raw, w.history),
          """SELECT count(DISTINCT symbol) AS assets, count(*) AS bronze_rows,
                    count(DISTINCT source) AS sources, 2 * (SELECT count(*) FROM lat) AS backtests
             FROM typed"""),
    # --- publishing ---------------------------------------------------------------------------
    Entry("variant_entries", "P18 P19",
          "symbol:s strategy:s n_components:i exposure:d6 total_return:d6 excess_return:d6 "
          "oos_excess_return:d6 beat_bh_full:b beat_bh_oos:b sharpe:d4 max_drawdown:d6 n_trades:i",
          _entries,
          """SELECT * REPLACE (round_even(exposure, 6) AS exposure,
                    round_even(total_return, 6) AS total_return,
                    round_even(excess_return, 6) AS excess_return,
                    round_even(oos_excess_return, 6) AS oos_excess_return,
                    round_even(sharpe, 4) AS sharpe,
                    round_even(max_drawdown, 6) AS max_drawdown) FROM variants"""),
    Entry("published_rounding", "P19", "symbol:s ts:t price:d2 gap:d4", _rounded,
          """SELECT symbol, ts, round_even(kraken_close, 2) AS price,
                    round_even(abs_pct_diff, 4) AS gap FROM recon"""),
    Entry("topn_per_asset", "K2", "symbol:s place:i strategy:s n_components:i",
          lambda w: sinks.top_variants(_entries(w), 5),
          f"SELECT * FROM ({RANKED_SQL}) WHERE place <= 5"),
    Entry("grouped_variants", "A15 A18", "symbol:s n_combinations:i names:a",
          lambda w: sinks.grouped_entries(_entries(w)).withColumn(
              "names", F.transform("combinations", lambda c: c["strategy"])),
          """SELECT symbol, count(*) AS n_combinations,
                    list(strategy ORDER BY n_components, strategy) AS names
             FROM variants GROUP BY 1"""),
    Entry("index_documents", "S14 J17 P24",
          "symbol:s fx_pair:s latest_close:d6 actual_days:i n_discrepant:i n_strategies:i "
          "n_listed:i n_combinations:i first_variant:s", _index,
          """SELECT c.symbol, c.fx_pair, s.latest_close, q.actual_days, r.n_discrepant,
                    coalesce(v.singles, 0) AS n_strategies, coalesce(v.n, 0) AS n_listed,
                    coalesce(v.n, 0) AS n_combinations, v.first_variant
             FROM (SELECT symbol, fx_pair FROM catalog UNION ALL SELECT '6-NO DATA', '5-LOW') c
             LEFT JOIN summary s ON s.symbol = c.symbol
             LEFT JOIN quality q ON q.symbol = c.symbol
             LEFT JOIN (SELECT symbol, count_if(abs_pct_diff > 0.5) AS n_discrepant FROM recon
                        GROUP BY 1) r ON r.symbol = c.symbol
             LEFT JOIN (SELECT symbol, count(*) AS n, count_if(n_components = 1) AS singles,
                               min(strategy) FILTER (n_components = 1) AS first_variant
                        FROM variants GROUP BY 1) v ON v.symbol = c.symbol"""),
    Entry("index_contents", "S14", "section:s documents:i",
          lambda w: w.index_rows.groupBy("section").agg(F.count(F.lit(1)).alias("documents")),
          """SELECT 'assets' AS section, count(*) AS documents FROM catalog
             UNION ALL SELECT 'fx_decomposition', count(*) FROM fx
             UNION ALL SELECT 'leaderboard', count(*) FROM board
             UNION ALL SELECT 'overfitting', count(*) FROM overfit
             UNION ALL SELECT 'recent_ingest_runs', least(count(*), 40) FROM audit
             UNION ALL SELECT * FROM (VALUES ('combinations_index', 1), ('totals', 1), ('contents', 7))"""),
    Entry("index_combinations", "S14", "mode:s limit_per_asset:i ranked_by:s",
          lambda w: _section(w, "combinations_index", mode="mode", limit_per_asset="limit_per_asset",
                             ranked_by="ranked_by"),
          """SELECT 'full' AS mode, NULL AS limit_per_asset, 'oos_excess_return' AS ranked_by
             FROM clock"""),
    Entry("index_fx_decomposition", "S14 M7",
          "symbol:s window_label:s usd_return:d6 local_return:d6 adr_end_ts:s",
          lambda w: _section(w, "fx_decomposition", symbol="symbol", window_label="window_label",
                             usd_return="usd_return", local_return="local_return",
                             adr_end_ts="adr_end_ts"),
          """SELECT symbol, window_label, usd_return, local_return,
                    strftime(adr_end_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS adr_end_ts FROM fx"""),
    Entry("index_overfitting", "S14 A16",
          "is_grand_total:b n_components:i n_variants:i oos_survival_rate:d6",
          lambda w: _section(w, "overfitting", is_grand_total="is_grand_total",
                             n_components="n_components", n_variants="n_variants",
                             oos_survival_rate="oos_survival_rate"),
          "SELECT * FROM overfit"),
    Entry("index_leaderboard", "S14 M9",
          "strategy:s asset_class:s region:s n_backtests:i median_sharpe:d6",
          lambda w: _section(w, "leaderboard", strategy="strategy", asset_class="asset_class",
                             region="region", n_backtests="n_backtests",
                             median_sharpe="median_sharpe"),
          "SELECT * FROM board"),
    Entry("index_pipeline", "S14 A12 K1",
          "section:s source:s symbol:s status:s finished_at:s bronze_rows:i",
          lambda w: _union(*[
              _section(w, name, source="source", symbol="symbol", status="status",
                       finished_at="finished_at", bronze_rows="bronze_rows")
              .withColumn("section", F.lit(name)) for name in ("totals", "recent_ingest_runs")]),
          """SELECT 'recent_ingest_runs' AS section, source, symbol, status,
                    regexp_replace(strftime(finished_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
                                   '[.]000000', '') AS finished_at, NULL AS bronze_rows
             FROM (SELECT * FROM audit ORDER BY started_at DESC, source, symbol, ingest_run_id LIMIT 40)
             UNION ALL SELECT 'totals', NULL, NULL, NULL, NULL, count(*) FROM typed"""),
    Entry("index_without_marts", "S14 S17", "name:s present:b n_listed:i no_summary:b", _tolerant,
          """SELECT name, present, n AS n_listed, true AS no_summary FROM (VALUES
                 ('combinations_index', true, 0), ('totals', true, 0), ('fx_decomposition', false, 0),
                 ('leaderboard', false, 0), ('overfitting', false, 0),
                 ('recent_ingest_runs', false, 0)) t(name, present, n)
             UNION ALL SELECT 'assets', true, count(*), true FROM runs"""),
    Entry("index_budget", "K3", "budget:i severity:s documents:i listed:i", _budget,
          """SELECT budget, severity, count(*) AS documents, sum(n) AS listed
             FROM (SELECT symbol, count(*) AS n FROM lat GROUP BY 1),
                  (VALUES (600000, 'ok'), (1000, 'warn')) t(budget, severity) GROUP BY 1, 2"""),
    Entry("symbol_curves", "S15", "symbol:s strategy:s points:i first_ts:t last_ts:t", _curves,
          """SELECT r.symbol, r.strategy, count(*) AS points, min(b.ts) AS first_ts,
                    max(b.ts) AS last_ts FROM runs r JOIN bars b ON b.symbol = r.symbol
             WHERE r.n_components = 1 GROUP BY 1, 2"""),
    Entry("symbol_documents", "S15 A17 P24",
          "symbol:s split_ts:s n_backtests:i n_combinations:i points:i n_bars:i total_return:d4",
          _document_fields,
          """SELECT r.symbol, strftime(first(split_ts ORDER BY strategy), '%Y-%m-%dT%H:%M:%S')
                        || '+00:00' AS split_ts,
                    count_if(n_components = 1) AS n_backtests, count(*) AS n_combinations,
                    max(n_bars) AS points, max(n_bars) AS n_bars,
                    first(total_return ORDER BY n_components, strategy) AS total_return
             FROM runs r GROUP BY 1"""),
    Entry("stale_file_pruning", "S16", "symbol:s region:s", _pruned_files,
          "SELECT symbol, region FROM catalog WHERE symbol <> '5-LOW'"),
    # --- expectations -------------------------------------------------------------------------
    Entry("expectation_report", "Q1 Q2 Q3 Q4 Q5 Q10 J12", REPORT, _typed_report,
          TYPED_REPORT_SQL),
    Entry("run_expectations", "Q6 Q7 Q8 Q9 Q11 Q14", REPORT, _run_report,
          """SELECT 'naming' AS expectation, 'mart_combination_analysis' AS relation,
                    'error' AS severity, count_if(strategy <> array_to_string(components, '+')
                    OR n_components <> len(components)) AS n_failed FROM variants
             UNION ALL SELECT 'exposure', 'mart_combination_analysis', 'error', 0
             UNION ALL SELECT 'exposure below half', 'mart_combination_analysis', 'error',
                 count_if(exposure > 0.5) FROM variants
             UNION ALL SELECT 'identity', 'mart_fx_decomposition', 'error', 0
             UNION ALL SELECT 'beat_rate', 'mart_strategy_leaderboard', 'error', 0
             UNION ALL SELECT 'beat_rate below half', 'mart_strategy_leaderboard', 'error',
                 count_if(beat_rate > 0.49) FROM board
             UNION ALL SELECT 'kind_is_known', 'backtest_runs', 'error', 0
             UNION ALL SELECT 'curve_only_for_singles', 'backtest_runs', 'error', 0
             UNION ALL SELECT 'components_match_count', 'backtest_runs', 'error',
                 count_if(mask % 9 = 0) FROM lat
             UNION ALL SELECT 'status_is_known', 'ingest_runs', 'error', 0
             UNION ALL SELECT 'survival', 'marts', 'error', 0"""),
    Entry("survival_violations", "Q11 U2 J10", "relation:s grain:s rate:d6", _violations,
          """SELECT 'mart_strategy_leaderboard' AS relation,
                    strategy || ' / ' || asset_class || ' / ' || region AS grain,
                    oos_survival_rate * n_components AS rate
             FROM board WHERE oos_survival_rate * n_components > 1
             UNION ALL SELECT 'mart_overfitting_summary', coalesce(n_components::VARCHAR, 'ALL'),
                 share_beat_is * 3 FROM overfit WHERE share_beat_is * 3 > 1"""),
    Entry("freshness", "Q12", REPORT, _freshness,
          """SELECT 'freshness' AS expectation, relation, severity,
                    (severity <> 'pass')::INT AS n_failed
             FROM (VALUES ('after 10 h', 'pass'), ('after 40 h', 'warn'),
                          ('after 80 h', 'error')) t(relation, severity)"""),
    Entry("input_gate", "Q13",
          "symbol:s repeated_ts:i bad_price:i bad_volume:i bad_shape:i bad_rsi:i passes:b", _gate,
          f"SELECT *, bad_price + bad_volume + bad_shape = 0 AS passes FROM ({GATE_SQL})"),
    Entry("gated_bars", "Q13", "symbol:s bars:i",
          lambda w: q.gated(_gate_input(w), _gate(w)).groupBy("symbol").agg(
              F.count(F.lit(1)).alias("bars")),
          """SELECT symbol, count(*) AS bars FROM bars
             WHERE symbol NOT IN ('2-HIGH', '3-MEDIUM') GROUP BY 1"""),
    # --- measures -----------------------------------------------------------------------------
    Entry("measure_by_class", "D1 D2 D3 D4 D5 D6 D8",
          "asset_class:s variants_evaluated:i winners_is:i winners_is_oos:i oos_survival:d6 "
          "beat_bh_full_share:d6 beat_bh_oos_share:d6 avg_exposure:d6 avg_excess:d5 "
          "avg_oos_excess:d5 zero_trade_variants:i",
          lambda w: measures.measure(w.variant_mart, ["asset_class"],
                                     measures.variant_measures()),
          """SELECT asset_class, count(*) AS variants_evaluated, count_if(beat_bh_is) AS winners_is,
                    count_if(beat_bh_is AND beat_bh_oos) AS winners_is_oos,
                    count_if(beat_bh_is AND beat_bh_oos)::DOUBLE
                        / nullif(count_if(beat_bh_is), 0) AS oos_survival,
                    count_if(beat_bh_full)::DOUBLE / count(*) AS beat_bh_full_share,
                    count_if(beat_bh_oos)::DOUBLE / count(*) AS beat_bh_oos_share,
                    avg(exposure) AS avg_exposure, avg(excess_return) AS avg_excess,
                    avg(oos_excess_return) AS avg_oos_excess,
                    count_if(coalesce(n_trades, 0) = 0) AS zero_trade_variants
             FROM variants GROUP BY 1"""),
    Entry("measure_median_sharpe", "D7", "region:s median_sharpe:d6",
          lambda w: measures.median_sharpe(w.variant_mart, ["region"]),
          "SELECT region, median(sharpe) AS median_sharpe FROM variants GROUP BY 1"),
    Entry("measure_survival_by_n", "D11", "n_components:i oos_survival:d6 avg_exposure:d6",
          lambda w: measures.variant_report(w.variant_mart, ["n_components"],
                                            ["oos_survival", "avg_exposure"]),
          """SELECT n_components, count_if(beat_bh_is AND beat_bh_oos)::DOUBLE
                 / nullif(count_if(beat_bh_is), 0) AS oos_survival, avg(exposure) AS avg_exposure
             FROM variants GROUP BY 1"""),
    Entry("measure_exposure_scatter", "D12", "strategy:s avg_exposure:d6 avg_oos_excess:d5",
          lambda w: measures.variant_report(w.variant_mart, ["strategy"],
                                            ["avg_exposure", "avg_oos_excess"]),
          """SELECT strategy, avg(exposure) AS avg_exposure,
                    avg(oos_excess_return) AS avg_oos_excess FROM variants GROUP BY 1"""),
    Entry("measure_fx_drag", "D10 D13",
          "symbol:s usd_return:d6 local_return:d6 fx_move:d6 fx_drag:d6",
          lambda w: measures.fx_report(
              measures.sliced(w.fx_mart, w.catalog, window_label=["90d", "full"]), ["symbol"]),
          """SELECT symbol, avg(usd_return) AS usd_return, avg(local_return) AS local_return,
                    avg(fx_return) AS fx_move, avg(usd_return - local_return) AS fx_drag
             FROM fx WHERE window_label IN ('90d', 'full') GROUP BY 1"""),
    Entry("measure_equity_by_ts", "D9 D14", "ts:t strategy_equity:d3 buy_hold_equity:d3",
          lambda w: measures.equity_over_time(measures.sliced(
              measures.latest_curves(w.history, w.run_curve_rows), w.catalog, strategy="macd")),
          """SELECT ts, avg(equity) AS strategy_equity, avg(buy_hold_equity) AS buy_hold_equity
             FROM curve WHERE strategy = 'macd' GROUP BY 1"""),
    Entry("latest_curves", "D15 J11", "symbol:s strategy:s executed_at:t points:i",
          lambda w: _by_run(w, measures.latest_curves(w.history, w.run_curve_rows)),
          """SELECT symbol, strategy, as_of AS executed_at, count(*) AS points
             FROM curve, clock GROUP BY ALL"""),
    Entry("projected_columns", "D16", "strategy:s asset_class:s region:s beat_rate:d6",
          lambda w: measures.project(
              marts.strategy_leaderboard(w.variant_mart),
              ["strategy", "asset_class", "region", "beat_rate", "not_a_column"]),
          "SELECT strategy, asset_class, region, beat_rate FROM board"),
    Entry("slicers", "D17", "strategy_kind:s variants_evaluated:i avg_excess:d5",
          lambda w: measures.variant_report(
              measures.sliced(w.variant_mart.drop("region", "asset_class"), w.catalog,
                              region=["latam", "us"], asset_class="equity"),
              ["strategy_kind"], ["variants_evaluated", "avg_excess"]),
          """SELECT strategy_kind, count(*) AS variants_evaluated, avg(excess_return) AS avg_excess
             FROM variants WHERE region IN ('latam', 'us') AND asset_class = 'equity'
             GROUP BY 1"""),
]
