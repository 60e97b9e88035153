"""Append-only bronze layer: fetch windows, idempotent append, replication, audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import mask_secrets

CANDLE_KEY = ("source", "symbol", "granularity", "candle_ts")
AUDIT_KEY = ("ingest_run_id",)
#: Columns a destination assigns itself; they never travel.
SURROGATES = ("raw_candle_id",)
#: Audit before candles: a candle refers to its audit row.
REPLICATED = (("ingest_runs", AUDIT_KEY), ("raw_candles", CANDLE_KEY))


def high_water_marks(bronze: DataFrame) -> DataFrame:
    """Newest stored bar per (source, symbol, granularity), for all keys at once."""
    return bronze.groupBy("source", "symbol", "granularity").agg(
        F.max("candle_ts").alias("watermark")
    )


def last_closed_day(now: Column) -> Column:
    return F.date_trunc("day", now) - F.make_dt_interval(F.lit(1))


def fetch_windows(wanted: DataFrame, marks: DataFrame, now: Column) -> DataFrame:
    """Next closed window per wanted key: mark + 1 day (or ``backfill_start``) to yesterday."""
    keys = ["source", "symbol", "granularity"]
    start = F.coalesce(
        F.col("watermark") + F.make_dt_interval(F.lit(1)), F.col("backfill_start")
    )
    return (
        wanted.join(marks, keys, "left")
        .withColumn("window_start", start)
        .withColumn("window_end", last_closed_day(now))
        .withColumn("is_empty", F.col("window_start") > F.col("window_end"))
        .drop("backfill_start")
    )


def select_new(landing: DataFrame, windows: DataFrame) -> DataFrame:
    """Landing candles inside the fetch window of their key."""
    keys = ["source", "symbol", "granularity"]
    inside = F.col("candle_ts").between(F.col("window_start"), F.col("window_end"))
    return (
        landing.join(windows.select(*keys, "window_start", "window_end"), keys)
        .where(inside)
        .drop("window_start", "window_end")
    )


def unseen(
    incoming: DataFrame,
    existing: DataFrame,
    key: Sequence[str] = CANDLE_KEY,
    *,
    first_by: str | None = None,
) -> DataFrame:
    """Rows that an append ignoring key conflicts would insert; a stored key is never replaced.

    With ``first_by`` the earliest arrival among repeats of a key is the one kept; without it
    repeats are taken to be identical.
    """
    key = list(key)
    if first_by is None:
        once = incoming.dropDuplicates(key)
    else:
        rest = [c for c in incoming.columns if c not in key]
        once = (
            incoming.groupBy(*key)
            .agg(F.min_by(F.struct(*rest), first_by).alias("_r"))
            .select(*key, "_r.*")
        )
    return once.join(existing.select(*key), key, "left_anti")


def portable_columns(df: DataFrame, surrogates: Sequence[str] = SURROGATES) -> list[str]:
    return [c for c in df.columns if c not in surrogates]


def replicate(
    source: DataFrame, target: DataFrame, key: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows to append to ``target``, and one row of counts (rows sent, rows inserted)."""
    staged = source.select(*portable_columns(source))
    fresh = unseen(staged, target, key)
    moved = staged.select(F.lit(1).alias("sent"), F.lit(0).alias("put")).unionByName(
        fresh.select(F.lit(0).alias("sent"), F.lit(1).alias("put"))
    )
    counts = moved.agg(F.sum("sent").alias("rows_sent"), F.sum("put").alias("rows_inserted"))
    return fresh, counts


def audit_rows(
    attempts: DataFrame, fetched: DataFrame, inserted: DataFrame, finished_at: Column
) -> DataFrame:
    """One audit row per attempt; a failed attempt inserted nothing and its error is masked."""
    keys = ["source", "symbol", "granularity"]
    got = fetched.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_fetched"))
    put = inserted.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_inserted"))
    failed = F.col("error").isNotNull()
    return (
        attempts.join(got, keys, "left")
        .join(put, keys, "left")
        .withColumn("rows_fetched", F.coalesce("rows_fetched", F.lit(0)))
        .withColumn(
            "rows_inserted",
            F.when(failed, F.lit(0)).otherwise(F.coalesce("rows_inserted", F.lit(0))),
        )
        .withColumn("status", F.when(failed, "failed").otherwise("success"))
        .withColumn("error", mask_secrets(F.col("error")))
        .withColumn("finished_at", finished_at)
    )


def rejected_rows(rejects: DataFrame, finished_at: Column) -> DataFrame:
    """Failed audit rows, one per key and reason: what was read and not inserted, and why."""
    return (
        rejects.groupBy("source", "symbol", "granularity", "reason")
        .agg(F.count(F.lit(1)).alias("rows_fetched"))
        .select(
            "source", "symbol", "granularity", "rows_fetched",
            F.lit(0).cast("long").alias("rows_inserted"),
            F.lit("failed").alias("status"),
            mask_secrets(F.col("reason")).alias("error"),
            finished_at.alias("finished_at"),
        )
    )


def run_outcome(attempts: DataFrame) -> DataFrame:
    """Classify attempts and decide whether the run may publish.

    A refused credential blocks publishing; so does a run where nothing succeeded and nothing was
    merely deferred by a rate limit.
    """
    refused = F.count_if(F.coalesce("auth_failed", F.lit(False)))
    deferred = F.count_if(F.coalesce("rate_limited", F.lit(False)))
    ok = F.count_if(F.col("status") == "success")
    failed = F.count_if((F.col("status") == "failed") & ~F.coalesce("rate_limited", F.lit(False)))
    return attempts.agg(
        ok.alias("n_ok"),
        failed.alias("n_failed"),
        deferred.alias("n_deferred"),
        refused.alias("n_refused"),
    ).withColumn(
        "publishable",
        (F.col("n_refused") == 0) & ((F.col("n_ok") > 0) | (F.col("n_deferred") > 0)),
    )
