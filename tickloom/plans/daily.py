"""The daily job: recorded responses in, one published generation out.

Every step is a set operation over all symbols, and a symbol that cannot be scored is a row of the
quarantine table instead of an exception: its raw candles stay stored, its bars are published, and
the scoring anti-joins it. The job stops before anything is published only where the ingestion says
so (refused credentials, or nothing fetched at all); readers then keep the last generation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import expectations
from tickloom.operators.accounting import Costs, assemble_runs, curve_points, score_variants
from tickloom.operators.indicators import indicators
from tickloom.operators.signals import Signal, assert_bars, not_binary, resolve_signals, signal_base
from tickloom.operators.variants import Variant
from tickloom.plans import marts, silver
from tickloom.session import materialise
from tickloom.sources import bronze
from tickloom.sources.feeds import clip_window
from tickloom.sources.generations import Generations
from tickloom.sources.json_sinks import index_sections
from tickloom.sources.store import append_candles, read_store
from tickloom.sources.tables import run_curves

Parser = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
QUARANTINE = "symbol string, stage string, reason string, n_bars bigint"
KEYS = ["source", "symbol", "granularity"]


class NothingToPublish(RuntimeError):
    """The ingestion gave no ground to publish; the last generation stays current."""


@dataclass(frozen=True)
class Scoring:
    """What is scored, and at which costs."""

    signals: Sequence[Signal]
    variants: Sequence[Variant]
    costs: Costs


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ingest(
    spark: SparkSession,
    store: str,
    feeds: Mapping[str, tuple[Parser, DataFrame]],
    now: Column,
    backfill_start: Column,
    attempts: DataFrame | None = None,
) -> DataFrame:
    """Append what the feeds bring inside each key's open window; returns the audit rows.

    ``attempts`` (source, symbol, granularity, error, and optionally auth_failed, rate_limited) are
    the fetches that failed before there was a response.
    """
    parsed = [parse(responses) for parse, responses in feeds.values()]
    # windows and appends both read the parsed bars
    bars = materialise(_union([good for good, _ in parsed]), "parsed_bars")
    rejects = materialise(_union([bad for _, bad in parsed]), "parsed_rejects")
    # of overlapping pages the last one wins, whatever its time
    span = bars.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    once = clip_window(bars, F.lit(span.a), F.lit(span.b)) if span.a is not None else bars.drop("page")
    landing = once.select(*KEYS, F.col("ts").alias("candle_ts"), "payload")

    stored = read_store(spark, store)
    marks = bronze.high_water_marks(landing.limit(0) if stored is None else stored)
    wanted = landing.select(*KEYS).distinct().withColumn("backfill_start", backfill_start)
    windows = bronze.fetch_windows(wanted, marks, now)
    offered = materialise(bronze.select_new(landing, windows), "offered")
    appended = append_candles(spark, offered, store)
    tried = wanted.drop("backfill_start").withColumns(
        {"error": F.lit(None).cast("string"), "auth_failed": F.lit(False), "rate_limited": F.lit(False)}
    )
    audit = bronze.audit_rows(tried, offered, appended.inserted, now)
    failed = bronze.rejected_rows(rejects, now).withColumns(
        {"auth_failed": F.lit(False), "rate_limited": F.lit(False)}
    )
    audit = audit.unionByName(failed, allowMissingColumns=True)
    if attempts is not None:
        none = attempts.limit(0).select(*KEYS)
        audit = audit.unionByName(
            bronze.audit_rows(attempts, none, none, now), allowMissingColumns=True
        )
    named = F.concat_ws("|", *KEYS, F.coalesce("error", F.lit("")), now.cast("string"))
    return materialise(
        audit.withColumns({"ingest_run_id": F.sha2(named, 256), "started_at": now}), "audit"
    )


def _quarantined(gate: DataFrame) -> DataFrame:
    """The gate's verdicts as rows, one for each rule a symbol breaks."""
    rules = ("repeated_ts", "bad_price", "bad_volume", "bad_shape", "bad_rsi")
    broken = gate.where("not passes").unpivot(["symbol"], list(rules), "reason", "n_bars")
    return broken.where("n_bars > 0").select("symbol", F.lit("bars").alias("stage"), "reason", "n_bars")


def isolated_scores(
    bars: DataFrame, catalog: DataFrame, scoring: Scoring, executed_at: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs, curve points of the runs that keep one, and the quarantine.

    Bars are judged before signals are computed, signals before they are accounted for.
    """
    gate = materialise(expectations.input_gate(bars, catalog), "gate")
    bad_bars = _quarantined(gate)
    good = expectations.gated(bars, gate)
    base = materialise(signal_base(good, scoring.signals), "signal_base")
    resolved = materialise(resolve_signals(base, scoring.signals), "signals")
    bad_signals = not_binary(resolved, scoring.signals).select(
        "symbol", F.lit("signals").alias("stage"),
        F.concat(F.lit("not 0 or 1: "), F.array_join("signals", ",")).alias("reason"), "n_bars",
    )
    quarantine = materialise(bad_bars.unionByName(bad_signals), "quarantine")
    sound = resolved.join(quarantine.select("symbol"), "symbol", "left_anti")
    metrics = score_variants(sound, catalog, scoring.signals, scoring.variants, scoring.costs)
    runs = materialise(assemble_runs(metrics, scoring.costs, executed_at), "scored_runs")
    singles = [v for v in scoring.variants if len(v.components) == 1]
    points = curve_points(sound, scoring.signals, singles, scoring.costs)
    return runs, run_curves(points, runs), quarantine


def daily_run(
    spark: SparkSession,
    root: str,
    feeds: Mapping[str, tuple[Parser, DataFrame]],
    catalog: DataFrame,
    scoring: Scoring,
    now: Column,
    backfill_start: Column,
    attempts: DataFrame | None = None,
) -> int:
    """Ingest, rebuild, score and publish; returns the number of the new generation.

    Raw candles live in ``root``/candles and only grow. All other layers belong to a generation:
    audit, bars, quarantine, runs, curves (a folder per symbol), variants, leaderboard, overfitting,
    expectations and index.
    """
    store, generations = f"{root}/candles", Generations(spark, root)
    audit = ingest(spark, store, feeds, now, backfill_start, attempts)
    outcome = bronze.run_outcome(audit).first()
    if not outcome.publishable:
        raise NothingToPublish(f"{outcome.n_refused} refused, {outcome.n_failed} failed, none succeeded")

    draft = generations.begin()
    draft.put("audit", audit)
    typed = silver.all_sources(read_store(spark, store))
    noted = Observation("bars")
    watched = silver.canonical(typed).observe(
        noted,
        F.count(F.lit(1)).alias("bars"),
        F.count_if("has_null_price").alias("has_null_price"),
        F.count_if("high_lt_low").alias("high_lt_low"),
    )
    bars = draft.put("bars", watched)
    assert_bars(bars)
    report = spark.createDataFrame(
        [(rule, "bars", expectations.WARN, noted.get[rule]) for rule in ("has_null_price", "high_lt_low")],
        "expectation string, relation string, severity string, n_failed bigint",
    )

    priced = bars.select("symbol", "ts", "open", "high", "low", "close", "volume")
    runs, curves, quarantine = isolated_scores(priced, catalog, scoring, now)
    draft.put("quarantine", quarantine)
    runs = draft.put("runs", runs)
    draft.put("curves", curves.join(runs.select("backtest_run_id", "symbol", "strategy"), "backtest_run_id"),
              by=("symbol",))
    variants = draft.put("variants", marts.combination_analysis(runs, catalog))
    board = draft.put("leaderboard", marts.strategy_leaderboard(variants))
    overfitting = draft.put("overfitting", marts.overfitting_summary(variants))
    rules = expectations.row_rules(runs, "runs", expectations.run_constraints())
    nested = expectations.survival_violations(board, overfitting).agg(
        F.lit("survival_nests").alias("expectation"), F.lit("leaderboard").alias("relation"),
        F.lit(expectations.ERROR).alias("severity"), F.count(F.lit(1)).alias("n_failed"),
    )
    report = draft.put("expectations", _union([report, rules, nested]))
    broken = expectations.blocking(report).collect()
    if broken:
        raise NothingToPublish("; ".join(f"{r.relation}: {r.expectation} ({r.n_failed})" for r in broken))

    draft.put(
        "index",
        index_sections(
            catalog, now,
            summary=marts.asset_summary(indicators(priced), catalog, now),
            quality=marts.data_quality(bars, catalog),
            reconciliation=marts.reconciliation_rollup(marts.source_reconciliation(typed)),
            runs=runs, variants=variants, overfitting=overfitting, leaderboard=board,
            fx_decomposition=marts.fx_decomposition(priced, catalog),
            totals=marts.totals(typed, runs), recent_ingest_runs=audit,
        ),
        by=("section",),
    )
    return draft.publish(now)
