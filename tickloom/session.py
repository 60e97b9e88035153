"""Session settings and the shared folder that holds materialised layers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings every plan relies on: UTC calendar arithmetic and adaptive re-planning
#: (skew splitting, partition coalescing, size-checked broadcast conversion).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application under the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is only acceptable when the whole application is one JVM, so it is
    created for ``local`` masters alone; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/tickloom-{context.applicationId}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = os.path.join(tempfile.gettempdir(), f"tickloom-{context.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet layer in the shared folder and read it back.

    This cuts lineage with a columnar table that survives executor loss and still gives later
    scans column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
