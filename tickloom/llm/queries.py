"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe_transducer, language_ftrl, oracle, secrets_markov, toxicity_nb
from tickloom.llm.common import ascii_lower, fold, table
from tickloom.llm.divergence_audit import source_audit
from tickloom.llm.imatch import compare_edited
from tickloom.llm.merkle_manifest import manifest
from tickloom.llm.mixture_packing import mixture_pack
from tickloom.llm.simhash_cover import near_duplicates
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.token_packing import pack_tokens
from tickloom.llm.url_globs import filter_urls
from tickloom.llm.winnowing import contamination
from tickloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return secrets_markov.digest(secrets_markov.find_secrets(docs))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return toxicity_nb.score_texts(docs, toxicity_nb.train(docs, table(spark, sf_dir, "labels")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(prepare(spark), sf_dir, "documents")).drop("spans", "kept")


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_pack(table(prepare(spark), sf_dir, "documents")).drop("source")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return language_ftrl.predict(docs, language_ftrl.train(docs))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(prepare(spark), sf_dir, x) for x in ("documents", "benchmark"))
    return contamination(docs, items).drop("text_hash")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(prepare(spark), sf_dir, "documents"))


def op8_url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(prepare(spark), sf_dir, "pages"))


def op9_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(prepare(spark), sf_dir, "documents"))


def op10_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(prepare(spark), sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return manifest(docs, altered=ascii_lower(F.col("text")), where=fold("doc_id", 5) == 0).drop("proof")


def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return bpe_transducer.digest(bpe_transducer.round_trip(docs))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)
}

ORACLES: dict[str, str] = {
    "op6_winnowing": oracle.WINNOWING,
    "op11_merkle_manifest": oracle.MERKLE,
    "op13_divergence_audit": oracle.DIVERGENCE,
}
