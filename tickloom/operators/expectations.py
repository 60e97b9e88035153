"""Data-quality expectations.

Every expectation yields one row ``(expectation, relation, severity, n_failed)``; an ``error``
with failures blocks. Row rules of one relation are counted together in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


def _false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def not_null(column: str, where: Column | None = None) -> Column:
    broken = F.col(column).isNull()
    return broken if where is None else broken & where


def accepted(column: str, values: Sequence) -> Column:
    """Outside the list; NULL passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def in_range(column: str, low: float, high: float) -> Column:
    """Outside [low, high]; NULL passes."""
    return _false((F.col(column) < low) | (F.col(column) > high))


def ohlc_inconsistent() -> Column:
    return _false(
        (F.col("high") < F.col("low"))
        | (F.col("close") < F.col("low"))
        | (F.col("close") > F.col("high"))
    )


def naming_broken() -> Column:
    """Name, size, kind and order of the components must agree (NULL-safe)."""
    parts = F.col("components")
    kind = F.when(F.size(parts) == 1, "single").otherwise("combo")
    return (
        ~F.col("strategy").eqNullSafe(F.array_join(parts, "+"))
        | ~F.col("n_components").eqNullSafe(F.size(parts))
        | ~F.col("strategy_kind").eqNullSafe(kind)
        | ~parts.eqNullSafe(F.array_sort(parts))
    )


def fx_identity_broken(tolerance: float = 1e-9) -> Column:
    error = F.abs(
        (1 + F.col("usd_return")) * (1 + F.col("fx_return")) - (1 + F.col("local_return"))
    )
    return _false(error >= tolerance)


def run_constraints() -> Mapping[str, Column]:
    """Table constraints of the run table, as row rules to check before an append."""
    return {
        "kind_is_known": accepted("strategy_kind", ["single", "combo"]),
        "curve_only_for_singles": _false((F.col("strategy_kind") != "single") & F.col("has_curve")),
        "components_match_count": _false(F.size("components") != F.col("n_components")),
    }


def audit_constraints() -> Mapping[str, Column]:
    return {"status_is_known": accepted("status", ["success", "failed"])}


def row_rules(
    df: DataFrame, relation: str, rules: Mapping[str, Column], severity: str = ERROR
) -> DataFrame:
    """All row rules of a relation in one aggregate, unpivoted to one row per rule."""
    counted = df.agg(
        *[F.count_if(_false(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("expectation"),
                F.lit(relation).alias("relation"),
                F.lit(severity).alias("severity"),
                F.col(f"r{i}").alias("n_failed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counted.select(F.inline(rows))


def _one(count: DataFrame, expectation: str, relation: str, severity: str) -> DataFrame:
    return count.select(
        F.lit(expectation).alias("expectation"),
        F.lit(relation).alias("relation"),
        F.lit(severity).alias("severity"),
        "n_failed",
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, relation: str, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    broken = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n_failed"))
    return _one(broken, f"unique({','.join(keys)})", relation, severity)


def orphans(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose value has no parent; NULL passes."""
    known = parent.select(F.col(key).alias(column))
    return df.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def relationship(
    df: DataFrame, relation: str, column: str, parent: DataFrame, key: str, severity: str = ERROR
) -> DataFrame:
    broken = orphans(df, column, parent, key).agg(F.count(F.lit(1)).alias("n_failed"))
    return _one(broken, f"relationship({column})", relation, severity)


def survival_violations(leaderboard: DataFrame, summary: DataFrame) -> DataFrame:
    """Rates outside [0, 1] and counts that do not nest, from both marts."""
    nested = (F.col("n_beat_is_and_oos") > F.col("n_beat_is_scored_oos")) | (
        F.col("n_beat_is_scored_oos") > F.col("n_beat_is")
    )

    def outside(rate: str) -> Column:
        return F.col(rate).isNotNull() & ((F.col(rate) < 0) | (F.col(rate) > 1))

    board = leaderboard.where(outside("oos_survival_rate") | nested).select(
        F.lit("mart_strategy_leaderboard").alias("relation"),
        F.concat_ws(" / ", "strategy", "asset_class", "region").alias("grain"),
        F.col("oos_survival_rate").alias("rate"),
    )
    rates = (
        "share_beat_full", "share_beat_is", "share_beat_oos", "share_beat_is_and_oos",
        "oos_survival_rate",
    )
    kept = (
        "n_components", "n_beat_is", "n_beat_is_and_oos", "n_beat_is_scored_oos",
        "n_evaluated_both", "n_evaluated_is", "n_evaluated_oos",
    )
    unpivoted = summary.unpivot(list(kept), list(rates), "rate_name", "rate")
    pooled = unpivoted.where(
        outside("rate")
        | nested
        | (F.col("n_evaluated_both") > F.least("n_evaluated_is", "n_evaluated_oos"))
    ).select(
        F.lit("mart_overfitting_summary").alias("relation"),
        F.coalesce(F.col("n_components").cast("string"), F.lit("ALL")).alias("grain"),
        "rate",
    )
    return board.unionByName(pooled)


def discrepancy_warning(rate: DataFrame, limit: float = 0.10) -> DataFrame:
    """Warn when the share of discrepant bars reaches ``limit``."""
    broken = rate.agg(
        F.count_if(_false(F.col("discrepant_rate") >= limit)).alias("n_failed")
    )
    return _one(broken, "discrepancy_rate", "mart_source_reconciliation", WARN)


def freshness(
    df: DataFrame, loaded_at: str, as_of: Column, relation: str,
    warn_hours: int = 36, error_hours: int = 72,
) -> DataFrame:
    """Age of the newest load; severity grows from pass to warn to error."""
    age = (F.unix_seconds(as_of) - F.unix_seconds("newest")) / 3600.0
    state = F.when(age > error_hours, ERROR).when(age > warn_hours, WARN).otherwise("pass")
    return df.agg(F.max(loaded_at).alias("newest")).select(
        F.lit("freshness").alias("expectation"),
        F.lit(relation).alias("relation"),
        state.alias("severity"),
        F.when(state == "pass", 0).otherwise(1).cast("long").alias("n_failed"),
    )


def input_gate(bars: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per-symbol counts of bars the scoring stage must not see, and the verdict.

    Prices positive and present, volume present (unless the class has no tape) and not negative,
    high and low around the body, RSI in [0, 100], timestamps unique. Repeats are found by a
    (symbol, ts) count that combines map-side, so no symbol is ordered.
    """
    classed = bars.join(catalog.select("symbol", "has_volume"), "symbol", "left")
    bad_price = F.lit(False)
    for price in ("open", "high", "low", "close"):
        bad_price = bad_price | F.coalesce(F.col(price) <= 0, F.lit(True)) | F.isnan(price)
    needs_volume = F.coalesce("has_volume", F.lit(True))
    bad_volume = _false(F.col("volume") < 0) | (F.col("volume").isNull() & needs_volume)
    bad_shape = _false(
        (F.col("high") < F.col("low"))
        | (F.col("high") < F.greatest("open", "close"))
        | (F.col("low") > F.least("open", "close"))
    )
    bad_rsi = in_range("rsi_14", 0, 100) if "rsi_14" in bars.columns else F.lit(False)
    rules = {
        "bad_price": bad_price, "bad_volume": bad_volume, "bad_shape": bad_shape,
        "bad_rsi": bad_rsi,
    }
    per_bar = classed.groupBy("symbol", "ts").agg(
        (F.count(F.lit(1)) - 1).alias("repeats"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    counted = per_bar.groupBy("symbol").agg(
        F.sum("repeats").alias("repeated_ts"), *[F.sum(name).alias(name) for name in rules]
    )
    total = reduce(lambda a, b: a + b, [F.col(c) for c in ("repeated_ts", *rules)])
    return counted.withColumn("passes", total == 0)


def gated(bars: DataFrame, gate: DataFrame) -> DataFrame:
    """Bars without the symbols that failed the gate; the other symbols go on."""
    return bars.join(gate.where("not passes").select("symbol"), "symbol", "left_anti")


def blocking(report: DataFrame) -> DataFrame:
    return report.where((F.col("severity") == ERROR) & (F.col("n_failed") > 0))
