"""The partitioned candle store: idempotent appends that read only the months they touch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.session import materialise
from tickloom.sources.bronze import CANDLE_KEY

PARTITIONS = ("source", "month")


def with_month(candles: DataFrame) -> DataFrame:
    return candles.withColumn("month", F.date_format("candle_ts", "yyyy-MM"))


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored candles with their ``month``; None when nothing is stored yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    # partition values are read back by their looks: a month could turn into a date
    return stored.withColumns({c: F.col(c).cast("string") for c in PARTITIONS})


def touched(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The part of the store in the partitions of ``incoming``.

    The list of (source, month) pairs is no longer than the table's own list of folders, which the
    driver holds to plan any scan. As literals the pairs become partition filters, so the folders of
    other months are not even listed as input.
    """
    parts = incoming.select(*PARTITIONS).distinct().collect()
    by_source: dict[str, list[str]] = {}
    for part in parts:
        by_source.setdefault(part.source, []).append(part.month)
    hit = [
        (F.col("source") == source) & F.col("month").isin(sorted(months))
        for source, months in sorted(by_source.items())
    ]
    return stored.where(reduce(lambda a, b: a | b, hit, F.lit(False)))


def already_stored(stored: DataFrame, incoming: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """Keys of ``incoming`` that the store holds.

    A semi-join from the store's side: the increment is the small side, which adaptive execution
    broadcasts when its size allows, and for which Spark builds a Bloom filter over the scan when
    it does not. Stored keys are only shuffled if they pass.
    """
    keys = list(key)
    return touched(stored, incoming).select(*keys).join(incoming.select(*keys), keys, "left_semi")


@dataclass(frozen=True)
class Appended:
    """What was offered (once per key, with the repeats counted) and what of it was inserted."""

    offered: DataFrame
    inserted: DataFrame

    def by_month(self) -> DataFrame:
        """source, month, offered and inserted candles."""
        put = self.inserted.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("inserted"))
        tried = self.offered.groupBy(*PARTITIONS).agg(F.sum("repeats").alias("offered"))
        return tried.join(put, list(PARTITIONS), "left").fillna(0, ["inserted"])


def append_candles(
    spark: SparkSession, incoming: DataFrame, path: str, *, first_by: str | None = None
) -> Appended:
    """Append the candles whose key is not stored.

    A stored key is never replaced. Of repeats inside ``incoming`` the one with the least
    ``first_by`` goes in (any one without it). Offering the same candles again inserts nothing.
    """
    keys = list(CANDLE_KEY)
    rest = [c for c in incoming.columns if c not in keys]
    once = incoming.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), first_by or rest[0]).alias("_r"), F.count(F.lit(1)).alias("repeats")
    )
    kept = [f"_r.{c}" for c in rest if c != first_by]
    once = materialise(with_month(once.select(*keys, *kept, "repeats")), "increment")
    stored = read_store(spark, path)
    fresh = once.drop("repeats")
    if stored is not None:
        fresh = fresh.join(already_stored(stored, once), keys, "left_anti")
    # judged once: what is reported is what is written
    fresh = materialise(fresh, "fresh_candles")
    # few files a folder, and adaptive execution splits a folder that is large
    dealt = fresh.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    dealt.write.mode("append").partitionBy(*PARTITIONS).parquet(path)
    return Appended(once, fresh)
