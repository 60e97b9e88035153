"""Layer tables: full rebuilds, optional relations, and the run writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


def rebuild(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a layer table with ``df`` and read it back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at ``path``, or an empty one of the same shape when it does not exist yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_available(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """The table at ``path`` when it exists and has the run grain, else ``fallback``.

    An existing empty table is used as it is; the choice never depends on its rows.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback
    return found if {"symbol", "strategy"} <= set(found.columns) else fallback


def run_curves(curves: DataFrame, runs: DataFrame) -> DataFrame:
    """Curve points of the runs that keep one, keyed by run id."""
    kept = runs.where("has_curve").select("backtest_run_id", "symbol", "strategy")
    return curves.join(kept, ["symbol", "strategy"]).select(
        "backtest_run_id", "ts", "equity", "buy_hold_equity"
    )


def append_runs(runs: DataFrame, curves: DataFrame, runs_path: str, curves_path: str) -> None:
    """Append run rows, and curve rows for the runs that keep a curve."""
    runs.write.mode("append").parquet(runs_path)
    run_curves(curves, runs).write.mode("append").parquet(curves_path)
