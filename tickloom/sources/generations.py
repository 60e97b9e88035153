"""Generations of stored layers: all layers of a run become visible together, or none.

Each run writes its layers into folders of its own. A manifest row per layer, all in one file, is
written last; a reader takes the newest manifest entry and the folders it names. A run that fails
half-way leaves folders nobody reads, and a reader never sees layers of two runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.tables import read_optional

MANIFEST = "generation bigint, layer string, path string, n_rows bigint, present boolean, written_at timestamp"


@dataclass(frozen=True)
class Snapshot:
    """The layers of one generation, fixed when it was taken."""

    spark: SparkSession
    number: int
    paths: Mapping[str, str]

    def read(self, layer: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[layer])

    def read_optional(self, layer: str, schema: str) -> DataFrame:
        """The layer, or an empty table of that shape where the generation has none."""
        return self.read(layer) if layer in self.paths else self.spark.createDataFrame([], schema)


class Generations:
    """The layers under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        return read_optional(self.spark, f"{self.root}/manifest", MANIFEST)

    def current(self) -> Snapshot | None:
        """The newest complete generation."""
        newest = self.manifest().agg(F.max("generation")).first()[0]
        return None if newest is None else self.at(newest)

    def at(self, number: int) -> Snapshot:
        rows = self.manifest().where((F.col("generation") == number) & F.col("present")).collect()
        return Snapshot(self.spark, number, {r.layer: r.path for r in rows})

    def history(self, layer: str) -> DataFrame | None:
        """A layer of all generations, with its ``generation``; None where no one has it."""
        rows = self.manifest().where((F.col("layer") == layer) & F.col("present")).collect()
        parts = [
            self.spark.read.parquet(r.path).withColumn("generation", F.lit(r.generation)) for r in rows
        ]
        whole = None
        for part in parts:
            whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
        return whole

    def begin(self) -> Draft:
        return Draft(self)


class Draft:
    """A generation being written."""

    def __init__(self, owner: Generations) -> None:
        self._owner, self._id = owner, uuid.uuid4().hex
        self._entries: list[tuple[str, str | None]] = []

    def put(self, layer: str, df: DataFrame | None, *, by: Sequence[str] = ()) -> DataFrame | None:
        """Write a layer and read it back; an absent one (None) is only noted."""
        if df is None:
            self._entries.append((layer, None))
            return None
        path = f"{self._owner.root}/{layer}/{self._id}"
        writer = df.write.mode("errorifexists")
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(path)
        self._entries.append((layer, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def publish(self, written_at: Column) -> int:
        """Make all layers the current generation, by one file."""
        spark, owner = self._owner.spark, self._owner
        newest = owner.manifest().agg(F.max("generation")).first()[0]
        number = (newest or 0) + 1
        rows = [
            (number, layer, path, spark.read.parquet(path).count() if path else 0, path is not None)
            for layer, path in self._entries
        ]
        entry = spark.createDataFrame(rows, MANIFEST.rsplit(", ", 1)[0]).withColumn("written_at", written_at)
        entry.coalesce(1).write.mode("append").parquet(f"{owner.root}/manifest")
        return number
