"""Headline timings on one machine: prints one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Each query is executed into a no-op sink. Layers a
query needs (signals, scored variants) are built inside the first query that uses them, so the
``scored_layers`` entry is the cost of the whole scoring stage from the raw tables.
"""

from __future__ import annotations

import json
import os
import time

from tickloom.registry import REGISTERED
from tickloom.registry.adapters import warehouse
from tickloom.session import local_session

HEADLINE = (
    "indicators",
    "bronze_parse",
    "source_priority_dedup",
    "source_reconciliation",
    "data_quality",
    "asset_summary",
    "fx_decomposition",
    "run_outcome",
    "wide_universe_metrics",
    "trades",
    "equity_curve",
    "combination_analysis",
    "leaderboard",
    "overfitting_summary",
    "retention_keep_n",
    "curve_cascade",
    "downsample_curve",
    "symbol_documents",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, memory="16g", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - started, 3)

    layers = warehouse(spark, folder)
    timed("bars_layer", lambda: layers.bars)
    timed("scored_layers", lambda: layers.metrics)
    for name in HEADLINE:
        timed(
            name,
            lambda: REGISTERED[name].run(spark, folder).write.format("noop").mode("overwrite")
            .save(),
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
