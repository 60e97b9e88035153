"""Retention of derived runs and their curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ranking import keep_recent

DEFAULT_KEEP = 2


def retain(runs: DataFrame, keep: int = DEFAULT_KEEP) -> DataFrame:
    """The ``keep`` newest runs per (symbol, strategy); each variant ages out on its own."""
    return keep_recent(
        runs,
        ["symbol", "strategy"],
        keep,
        F.col("executed_at").desc(),
        F.col("backtest_run_id").desc(),
    )


def pruned(runs: DataFrame, survivors: DataFrame) -> DataFrame:
    """Runs that retention removes."""
    return runs.join(survivors.select("backtest_run_id"), "backtest_run_id", "left_anti")


def pruned_count(runs: DataFrame, survivors: DataFrame) -> DataFrame:
    """Number of runs removed, as one row."""
    return pruned(runs, survivors).agg(F.count(F.lit(1)).alias("n_pruned"))


def cascade(children: DataFrame, survivors: DataFrame) -> DataFrame:
    """Child rows (curve points) whose run survives."""
    return children.join(survivors.select("backtest_run_id"), "backtest_run_id", "left_semi")


def backfill_components(runs: DataFrame) -> DataFrame:
    """Legacy rows with an empty component list are singles named by themselves."""
    empty = F.coalesce(F.size("components"), F.lit(0)) <= 0
    return runs.withColumn(
        "n_components", F.when(empty, F.lit(1)).otherwise(F.col("n_components"))
    ).withColumn(
        "components",
        F.when(empty, F.array("strategy")).otherwise(F.col("components")),
    )
