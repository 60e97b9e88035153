"""The training-data pipeline: five text operators over ``documents``, each on what is left.

Every stage's result is written as Parquet in the shared folder and read again, so a lost executor
costs at most the stage in hand. All stages but the last return the columns of ``documents``.

- ``toxicity`` drops the documents scored at or above the threshold (a null text scores as empty).
- ``near_duplicates`` keeps the smallest doc_id of each group (rows without an id stay).
- ``decontamination`` drops the documents of which a twentieth or more are benchmark words.
- ``secrets`` replaces each span by a mark; no document is dropped.
- ``packing`` cuts the rest into pieces of full training windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import table
from tickloom.llm.mixture_packing import mixture_pack
from tickloom.llm.secrets_markov import redacted
from tickloom.llm.simhash_cover import one_per_group
from tickloom.llm.toxicity_nb import without_toxic
from tickloom.llm.winnowing import without_benchmark
from tickloom.session import materialise, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture_pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: No SQL: the trained scores, 64-bit hashes and token ids are beyond it. Tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that pass every stage."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
