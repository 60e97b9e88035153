"""What the text operators share: reading, safe columns, fold tests, global numbering, merges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; null reads as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept; pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fold(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(modulus))


def repeat_until_empty(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches that have rows."""
    for frame in frames:
        if len(frame):
            yield frame


def numbered_parts(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-sorted and stored with its place: ``part`` and ``row`` (ascending in a part).

    Places are written once, so a recomputed task cannot number rows in another way.
    """
    placed = df.orderBy(*order).withColumns(
        {
            "part": F.spark_partition_id(),
            "row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    return materialise(placed, name)


def unions(pairs: np.ndarray, size: int) -> np.ndarray:
    """Smallest member of each node's component; ``pairs`` holds links between 0..size-1."""
    root = np.arange(size)
    a, b = pairs[:, 0], pairs[:, 1]
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            hop = root[root]
            if (hop == root).all():
                break
            root = hop
        if (before == root).all():
            break
    return root
