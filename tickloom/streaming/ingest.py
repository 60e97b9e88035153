"""Run the bronze append over newly arrived response files, then stop.

This only changes how a batch is triggered: each micro-batch goes through the same idempotent
append as a batch run, so a replayed batch inserts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.sources.bronze import CANDLE_KEY, rejected_rows, unseen
from tickloom.sources.tables import read_optional


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    audit: str,
) -> StreamingQuery:
    """Parse every response file not seen before and append its new candles to ``bronze``.

    Rejects become failed rows of ``audit``, in a folder per micro-batch: a replayed batch
    overwrites its own.
    """
    files = spark.readStream.schema("symbol string, page int, response string").json(landing)

    def append(batch: DataFrame, batch_id: int) -> None:
        parsed, rejects = parse(batch)
        candles = parsed.select(
            "source", "symbol", "granularity", parsed["ts"].alias("candle_ts"), "payload", "page"
        )
        stored = read_optional(batch.sparkSession, bronze, candles.drop("page").schema)
        fresh = unseen(candles, stored, CANDLE_KEY, first_by="page").drop("page")
        fresh.write.mode("append").parquet(bronze)
        failed = rejected_rows(rejects, F.current_timestamp())
        failed.write.mode("overwrite").parquet(f"{audit}/batch={batch_id}")

    return (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
