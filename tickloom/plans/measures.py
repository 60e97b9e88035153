"""Dashboard measures: filtered group-bys over the variant mart, the FX mart and the curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ranking import exact_median
from tickloom.functions.scalars import existing, ratio
from tickloom.plans.marts import latest_runs


def sliced(df: DataFrame, catalog: DataFrame, **choices: str | Sequence[str]) -> DataFrame:
    """Apply slicers; columns the fact lacks are looked up in the catalog by symbol."""
    remote = [c for c in choices if c not in df.columns]
    if remote:
        df = df.join(catalog.select("symbol", *remote), "symbol")
    for column, wanted in choices.items():
        values = [wanted] if isinstance(wanted, str) else list(wanted)
        df = df.where(F.col(column).isin(*values))
    return df


def _won(*flags: str) -> Column:
    condition = F.lit(True)
    for flag in flags:
        condition = condition & F.col(flag)
    return F.count_if(condition)


def variant_measures() -> Mapping[str, Column]:
    """Measures over the variant mart. The survival rate here divides by ALL in-sample winners."""
    rows = F.count(F.lit(1))
    return {
        "variants_evaluated": rows,
        "winners_is": _won("beat_bh_is"),
        "winners_is_oos": _won("beat_bh_is", "beat_bh_oos"),
        "oos_survival": ratio(_won("beat_bh_is", "beat_bh_oos"), _won("beat_bh_is")),
        "beat_bh_full_share": ratio(_won("beat_bh_full"), rows),
        "beat_bh_oos_share": ratio(_won("beat_bh_oos"), rows),
        "avg_exposure": F.avg("exposure"),
        "avg_excess": F.avg("excess_return"),
        "avg_oos_excess": F.avg("oos_excess_return"),
        "zero_trade_variants": F.count_if(F.coalesce("n_trades", F.lit(0)) == 0),
    }


FX_MEASURES = {
    "usd_return": "usd_return",
    "local_return": "local_return",
    "fx_move": "fx_return",
    "fx_drag": "fx_drag_pp",
}


def measure(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in measures.items()])


def variant_report(variants: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    known = variant_measures()
    return measure(variants, by, {name: known[name] for name in names})


def median_sharpe(variants: DataFrame, by: Sequence[str]) -> DataFrame:
    return exact_median(variants, by, "sharpe").withColumnRenamed("median", "median_sharpe")


def fx_report(fx: DataFrame, by: Sequence[str]) -> DataFrame:
    return measure(fx, by, {name: F.avg(column) for name, column in FX_MEASURES.items()})


def latest_curves(runs: DataFrame, curves: DataFrame) -> DataFrame:
    """Curve points of the latest run per (symbol, strategy) that keeps a curve."""
    chosen = latest_runs(runs.where("has_curve")).select("backtest_run_id", "symbol", "strategy")
    return curves.join(chosen, "backtest_run_id")


def equity_over_time(curves: DataFrame, by: Sequence[str] = ("ts",)) -> DataFrame:
    return curves.groupBy(*by).agg(
        F.avg("equity").alias("strategy_equity"), F.avg("buy_hold_equity").alias("buy_hold_equity")
    )


def project(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Columns of ``wanted`` that exist, in that order."""
    return df.select(*existing(df, wanted))


def leaderboard_order(df: DataFrame) -> DataFrame:
    """Order a leaderboard by whichever of its label columns exist; for sinks only."""
    return df.orderBy(*existing(df, ("strategy", "asset_class", "region")))
