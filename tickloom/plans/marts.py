"""Descriptive marts over canonical bars and summary marts over scored runs.

Small relations (catalog, one row per symbol) are joined without hints: adaptive execution turns
such a join into a broadcast only after it has seen the size, and splits a skewed symbol otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ranking import exact_median, latest_per_key
from tickloom.functions.scalars import (
    LOOKBACKS,
    beats,
    component_list,
    compound,
    growth,
    pct_gap,
    periods_per_year,
    ratio,
)
from tickloom.functions.series import largest_step

DISCREPANT_PCT = 0.5
# Labels that mark a row pooled over all sizes, in lower case.
POOLED_LABELS = ("all", "overall", "total")
STALE_DAYS = 3


def source_reconciliation(typed: DataFrame) -> DataFrame:
    """Closes of the two crypto venues for the bars both cover.

    One scan: each venue's close is a conditional aggregate of the bar, combined map-side. A bar is
    unique per source, so there is one row to take.
    """
    def side(source: str, name: str) -> list[Column]:
        own = F.col("source") == source
        return [
            F.max(F.when(own, F.col("close"))).alias(name),
            F.count_if(own).alias(f"_{name}"),
        ]

    gap = pct_gap(F.col("coinbase_close"), F.col("kraken_close"))
    return (
        typed.where(F.col("source").isin("coinbase", "kraken"))
        .groupBy("symbol", "ts")
        .agg(*side("coinbase", "coinbase_close"), *side("kraken", "kraken_close"))
        .where("_coinbase_close > 0 and _kraken_close > 0")
        .drop("_coinbase_close", "_kraken_close")
        .withColumn("abs_pct_diff", gap)
        .withColumn(
            "is_discrepant", F.coalesce(F.col("abs_pct_diff") > DISCREPANT_PCT, F.lit(False))
        )
    )


def reconciliation_rollup(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.groupBy("symbol").agg(
        F.count_if("is_discrepant").alias("n_discrepant"),
        F.max("abs_pct_diff").alias("max_abs_pct_diff"),
    )


def discrepancy_rate(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.agg(
        ratio(F.count_if("is_discrepant"), F.count(F.lit(1))).alias("discrepant_rate")
    )


def calendar_days(spans: DataFrame) -> DataFrame:
    """Days each symbol should have: every day for crypto, Monday to Friday otherwise."""
    day = F.explode(F.sequence("first_date", "last_date", F.make_dt_interval(F.lit(1))))
    return spans.withColumn("day", day).where(
        (F.col("asset_class") == "crypto") | (F.weekday("day") < 5)
    )


def data_quality(bars: DataFrame, catalog: DataFrame) -> DataFrame:
    """Completeness per catalogued symbol. A symbol with no expected day has no row."""
    dated = bars.withColumn("candle_date", F.to_date("ts"))
    spans = (
        dated.groupBy("symbol")
        .agg(
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.min("candle_date").alias("first_date"),
            F.max("candle_date").alias("last_date"),
            F.count(F.lit(1)).alias("actual_days"),
            F.count_if("has_null_price").alias("n_null_price"),
            F.count_if("is_zero_volume").alias("n_zero_volume"),
        )
        .join(catalog.select("symbol", "asset_class", "region"), "symbol")
    )
    expected = (
        calendar_days(spans.select("symbol", "asset_class", "first_date", "last_date"))
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("expected_days"))
    )
    gaps = largest_step(dated.select("symbol", "ts", "candle_date"), "candle_date", ("symbol",))
    return (
        spans.join(expected, "symbol")
        .join(gaps, "symbol", "left")
        .select(
            "symbol", "asset_class", "region", "first_ts", "last_ts", "expected_days",
            "actual_days",
            (F.col("expected_days") - F.col("actual_days")).alias("missing_days"),
            F.coalesce("largest_step", F.lit(0)).alias("max_gap_days"),
            "n_null_price",
            "n_zero_volume",
        )
    )


def ends(bars: DataFrame) -> DataFrame:
    """Latest bar per symbol; plain ``max`` and ``max_by``, so it combines map-side."""
    return bars.groupBy("symbol").agg(
        F.max("ts").alias("end_ts"), F.max_by("close", "ts").alias("end_close")
    )


def lookback_starts(bars: DataFrame, latest: DataFrame) -> DataFrame:
    """Last close at or before (own end - lookback), per symbol and label.

    Every bar is compared with its own symbol's end and aggregated; there is no range self-join.
    The whole-history label starts at the first bar.
    """
    joined = bars.join(latest.select("symbol", "end_ts"), "symbol")
    timed = [item for item in LOOKBACKS if item[1] is not None]
    aggregates = []
    for label, days in timed:
        inside = F.col("ts") <= F.col("end_ts") - F.make_dt_interval(F.lit(days))
        stamp = F.when(inside, F.col("ts"))
        aggregates += [F.max(stamp).alias(f"ts_{label}"), F.max_by("close", stamp).alias(label)]
    wide = joined.groupBy("symbol").agg(
        *aggregates, F.min("ts").alias("ts_full"), F.min_by("close", "ts").alias("full")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("window_label"),
                F.col(f"ts_{label}").alias("start_ts"),
                F.col(label).alias("start_close"),
            )
            for label, _ in LOOKBACKS
        ]
    )
    return wide.select("symbol", F.inline(rows)).where("start_ts is not null")


def asset_summary(indicator_rows: DataFrame, catalog: DataFrame, as_of: Column) -> DataFrame:
    """Latest close, 30-day return, annualised 30-day volatility and staleness per symbol."""
    rows = indicator_rows.select("symbol", "ts", "close", "daily_return")
    latest = ends(rows)
    cutoff = F.col("end_ts") - F.make_dt_interval(F.lit(30))
    earlier = F.when(F.col("ts") <= cutoff, F.col("ts"))
    month = (
        rows.join(latest.select("symbol", "end_ts"), "symbol")
        .groupBy("symbol")
        .agg(
            F.max_by("close", earlier).alias("start_close"),
            F.stddev_samp(F.when(F.col("ts") > cutoff, F.col("daily_return"))).alias("deviation"),
        )
    )
    age = as_of - F.col("end_ts")
    return (
        latest.join(catalog.select("symbol", "asset_class", "region"), "symbol")
        .join(month, "symbol", "left")
        .select(
            "symbol",
            "asset_class",
            "region",
            F.col("end_close").alias("latest_close"),
            growth(F.col("end_close"), F.col("start_close")).alias("return_30d"),
            (F.col("deviation") * F.sqrt(periods_per_year(F.col("asset_class")))).alias(
                "volatility_30d"
            ),
            F.col("end_ts").alias("last_candle_ts"),
            (age > F.make_dt_interval(F.lit(STALE_DAYS))).alias("is_stale"),
        )
    )


def fx_decomposition(bars: DataFrame, catalog: DataFrame) -> DataFrame:
    """Currency share of each receipt's return, per lookback window.

    Both legs use their own anchors; a missing leg leaves NULLs, never zeros.
    """
    receipts = catalog.where("fx_pair is not null").select("symbol", "region", "fx_pair")
    wanted = receipts.select("symbol").union(receipts.select(F.col("fx_pair").alias("symbol")))
    closes = bars.select("symbol", "ts", "close").join(wanted, "symbol", "left_semi")
    latest = ends(closes)
    starts = lookback_starts(closes, latest)

    def leg(df: DataFrame, key: str, prefix: str) -> DataFrame:
        return df.select(
            F.col("symbol").alias(key),
            *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in ("symbol",)],
        )

    windows = F.explode(F.array(*[F.lit(label) for label, _ in LOOKBACKS]))
    out = (
        receipts.withColumn("window_label", windows)
        .join(leg(latest, "symbol", "adr"), "symbol", "left")
        .join(
            leg(starts, "symbol", "adr").withColumnRenamed("adr_window_label", "window_label"),
            ["symbol", "window_label"],
            "left",
        )
        .join(leg(latest, "fx_pair", "fx"), "fx_pair", "left")
        .join(
            leg(starts, "fx_pair", "fx").withColumnRenamed("fx_window_label", "window_label"),
            ["fx_pair", "window_label"],
            "left",
        )
        .withColumn("usd_return", growth(F.col("adr_end_close"), F.col("adr_start_close")))
        .withColumn("fx_return", growth(F.col("fx_end_close"), F.col("fx_start_close")))
        .withColumn("local_return", compound(F.col("usd_return"), F.col("fx_return")))
    )
    return out.select(
        "symbol", "region", "fx_pair", "window_label", "usd_return", "fx_return", "local_return",
        (F.col("usd_return") - F.col("local_return")).alias("fx_drag_pp"),
        "adr_start_ts", "adr_end_ts", "fx_start_ts", "fx_end_ts",
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run per (symbol, strategy); the run id breaks ties."""
    return latest_per_key(
        runs, ["symbol", "strategy"], F.col("executed_at").desc(), F.col("backtest_run_id").desc()
    )


def combination_analysis(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Latest run of each variant with excess returns and beat flags for every window.

    The flags follow three-valued logic: an unscored window has no trades, so its flag is FALSE.
    """
    fresh = latest_runs(runs).withColumn(
        "components", component_list(F.col("components"), F.col("strategy"))
    )
    joined = fresh.join(catalog.select("symbol", "asset_class", "region"), "symbol")
    for prefix in ("", "is_", "oos_"):
        joined = joined.withColumn(
            f"{prefix}excess_return",
            F.col(f"{prefix}total_return") - F.col(f"{prefix}buy_hold_return"),
        )

    def beat(prefix: str) -> Column:
        return beats(
            F.col(f"{prefix}total_return"),
            F.col(f"{prefix}buy_hold_return"),
            F.col(f"{prefix}n_trades"),
        )

    return joined.select(
        "symbol", "asset_class", "region", "strategy", "strategy_kind", "n_components",
        "components", "has_curve", "executed_at", "n_bars", "split_ts", "exposure",
        "total_return", "buy_hold_return", "excess_return", "sharpe", "max_drawdown", "n_trades",
        "is_total_return", "is_buy_hold_return", "is_excess_return", "is_sharpe",
        "is_max_drawdown", "is_n_trades",
        "oos_total_return", "oos_buy_hold_return", "oos_excess_return", "oos_sharpe",
        "oos_max_drawdown", "oos_n_trades", "is_exposure", "oos_exposure",
        (F.col("is_excess_return") - F.col("oos_excess_return")).alias("oos_excess_drop"),
        beat("").alias("beat_bh_full"),
        beat("is_").alias("beat_bh_is"),
        beat("oos_").alias("beat_bh_oos"),
    )


def _winners() -> list[Column]:
    scored = F.col("beat_bh_is") & F.col("oos_excess_return").isNotNull()
    return [
        F.count_if("beat_bh_is").alias("n_beat_is"),
        F.count_if(scored).alias("n_beat_is_scored_oos"),
        F.count_if(F.col("beat_bh_is") & F.col("beat_bh_oos")).alias("n_beat_is_and_oos"),
    ]


def strategy_leaderboard(variants: DataFrame) -> DataFrame:
    """Per (strategy, class, region) plus one total per strategy, in one grouping-sets pass.

    The median is joined from a distributed order statistic instead of gathering each group.
    """
    attributes = ["strategy", "strategy_kind", "n_components"]
    cells = [*attributes, "asset_class", "region"]
    total = F.grouping("asset_class") == 1
    aggregated = variants.groupingSets(
        [[F.col(c) for c in cells], [F.col(c) for c in attributes]],
        *[F.col(c) for c in cells],
    ).agg(
        total.alias("is_grand_total"),
        F.count(F.lit(1)).alias("n_backtests"),
        F.count_if("beat_bh_full").alias("n_beat_buy_hold"),
        F.avg("total_return").alias("avg_total_return"),
        F.avg("buy_hold_return").alias("avg_buy_hold_return"),
        F.avg("excess_return").alias("avg_excess_return"),
        F.avg("max_drawdown").alias("avg_max_drawdown"),
        F.avg("n_trades").alias("avg_n_trades"),
        F.avg("exposure").alias("avg_exposure"),
        F.avg("is_excess_return").alias("avg_is_excess_return"),
        F.avg("oos_excess_return").alias("avg_oos_excess_return"),
        *_winners(),
    )
    both = variants.select(
        "strategy", "asset_class", "region", "sharpe", F.lit(False).alias("is_grand_total")
    ).unionByName(
        variants.select(
            "strategy",
            F.lit("ALL").alias("asset_class"),
            F.lit("ALL").alias("region"),
            "sharpe",
            F.lit(True).alias("is_grand_total"),
        )
    )
    place = ["strategy", "asset_class", "region", "is_grand_total"]
    medians = exact_median(both, place, "sharpe").withColumnRenamed("median", "median_sharpe")
    label = {
        c: F.when(F.col("is_grand_total"), F.lit("ALL")).otherwise(F.col(c))
        for c in ("asset_class", "region")
    }
    return (
        aggregated.withColumns(label)
        .join(medians, place, "left")
        .select(
            "strategy", "strategy_kind", "n_components", "asset_class", "region",
            "is_grand_total", "n_backtests", "n_beat_buy_hold",
            ratio(F.col("n_beat_buy_hold"), F.col("n_backtests")).alias("beat_rate"),
            "avg_total_return", "avg_buy_hold_return", "avg_excess_return", "median_sharpe",
            "avg_max_drawdown", "avg_n_trades", "avg_exposure", "avg_is_excess_return",
            "avg_oos_excess_return", "n_beat_is", "n_beat_is_scored_oos", "n_beat_is_and_oos",
            ratio(F.col("n_beat_is_and_oos"), F.col("n_beat_is_scored_oos")).alias(
                "oos_survival_rate"
            ),
        )
    )


def overfitting_summary(variants: DataFrame) -> DataFrame:
    """Per combination size plus one pooled row; shares divide by what was actually scored."""
    size = F.col("n_components")
    counted = variants.groupingSets([[size], []], size).agg(
        (F.grouping("n_components") == 1).alias("is_grand_total"),
        F.count(F.lit(1)).alias("n_variants"),
        F.count("excess_return").alias("n_evaluated_full"),
        F.count("is_excess_return").alias("n_evaluated_is"),
        F.count("oos_excess_return").alias("n_evaluated_oos"),
        F.count("oos_excess_drop").alias("n_evaluated_both"),
        F.count_if("beat_bh_full").alias("n_beat_full"),
        F.count_if("beat_bh_oos").alias("n_beat_oos"),
        *_winners(),
        *[
            F.avg(c).alias(f"avg_{c}")
            for c in (
                "exposure", "excess_return", "is_excess_return", "oos_excess_return",
                "oos_excess_drop",
            )
        ],
    )
    shares = {
        "share_beat_full": ("n_beat_full", "n_evaluated_full"),
        "share_beat_is": ("n_beat_is", "n_evaluated_is"),
        "share_beat_oos": ("n_beat_oos", "n_evaluated_oos"),
        "share_beat_is_and_oos": ("n_beat_is_and_oos", "n_evaluated_both"),
        "oos_survival_rate": ("n_beat_is_and_oos", "n_beat_is_scored_oos"),
    }
    rated = counted.withColumns({k: ratio(F.col(a), F.col(b)) for k, (a, b) in shares.items()})
    return rated.select(
        "is_grand_total", "n_components", "n_variants", "n_evaluated_full", "n_evaluated_is",
        "n_evaluated_oos", "n_evaluated_both", "n_beat_full", "n_beat_is",
        "n_beat_is_scored_oos", "n_beat_oos", "n_beat_is_and_oos", *shares, "avg_exposure",
        "avg_excess_return", "avg_is_excess_return", "avg_oos_excess_return",
        "avg_oos_excess_drop",
    )


def split_overall(summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detail rows by size, and the single pooled row.

    A pooled row says so by its flag, by having no size, or by a label in any text column.
    """
    pooled = F.lit(False)
    if "is_grand_total" in summary.columns:
        pooled = pooled | F.coalesce("is_grand_total", F.lit(False))
    if "n_components" in summary.columns:
        pooled = pooled | F.col("n_components").isNull()
    for name, kind in summary.dtypes:
        if kind == "string":
            pooled = pooled | F.coalesce(F.lower(name).isin(*POOLED_LABELS), F.lit(False))
    return summary.where(~pooled), summary.where(pooled)


def totals(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """What the pipeline has produced: assets, runs, raw rows and sources, in one row."""
    raw = bronze.agg(
        F.countDistinct("symbol").alias("assets"),
        F.count(F.lit(1)).alias("bronze_rows"),
        F.countDistinct("source").alias("sources"),
    )
    made = runs.agg(F.count(F.lit(1)).alias("backtests"))
    both = raw.unionByName(made, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def recent_attempts(audit: DataFrame, limit: int) -> DataFrame:
    """Most recent ingest attempts; a sort with a limit keeps ``limit`` rows per partition."""
    return (
        audit.orderBy(F.col("started_at").desc(), "source", "symbol", "ingest_run_id")
        .limit(limit)
        .select("source", "symbol", "status", "rows_fetched", "rows_inserted", "finished_at")
    )
