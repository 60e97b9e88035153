"""Clashing column names, also on training tables, and rows repeated under one id."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import language_ftrl, secrets_markov, simhash_cover, toxicity_nb, winnowing

NAMES = (
    "y fold label_id text_id chosen_id turn fit shard lang_pred held_out row id hash kept_id kept_hash place "
    "dirty_id dirty_hash _id _hash text_hash fp root component_id first first_id h spans doc at r others toxic "
    "readable z score predicted task rank block"
).split()


def clashing(df):
    return df.select("*", *[F.lit("other").alias(c) for c in NAMES if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark, small_dir):
    return clashing(spark.read.parquet(f"{small_dir}/documents.parquet"))


def test_stages_with_every_internal_name(spark, small_dir, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small_dir)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).count() > 0


def test_learned_operators_with_every_internal_name(spark, small_dir, docs):
    labels = clashing(spark.read.parquet(f"{small_dir}/labels.parquet"))
    model = toxicity_nb.train(docs, labels)
    assert toxicity_nb.score_texts(docs, model).count() == docs.count()
    small = language_ftrl.Settings(fit_rows=60, calibration_rows=20, shards=2)
    assert language_ftrl.predict(docs, language_ftrl.train(docs, small)).count() == docs.count()
    assert secrets_markov.labelled_samples(docs).count() > 0


def test_samples_are_bounded_under_repeated_ids(spark):
    rows = [(i % 3, f"word{i} and more", "en" if i % 2 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i % 3, i % 2) for i in range(300)], "doc_id long, toxic int")
    sample = toxicity_nb.training_rows(docs, labels, toxicity_nb.Settings()).collect()
    # ids 0 and 2 are outside the held-out fold; a label of 1 wins
    assert len(sample) <= 3 and all(r.y == 1 for r in sample)
    settings = language_ftrl.Settings(fit_rows=2, calibration_rows=1, floor_rows=1)
    assert language_ftrl._chosen(language_ftrl._training(docs), settings).count() <= 3
    assert secrets_markov.labelled_samples(docs).filter("label = 1").count() == 3 * 4


def test_a_rare_language_is_in_the_sample(spark):
    rows = [(i, f"text {i}", "big") for i in range(500)] + [(1_000, "rare words", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language_ftrl._training(docs)
    settings = language_ftrl.Settings(fit_rows=5, calibration_rows=2, floor_rows=1)
    chosen = {r.chosen_id for r in language_ftrl._chosen(held, settings).collect()}
    assert 1_000 in chosen or not held.filter("doc_id = 1000").count()
    assert len(chosen) <= 5 + 2 + 2


@pytest.mark.parametrize("parts", [1, 5])
def test_two_texts_under_one_id_are_two_documents(spark, parts):
    rng = random.Random(2)
    a, b, c = (" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, a, "x"), (3, b, "x"), (4, c, "x"), (4, c, "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(parts)
    out = [tuple(r) for r in simhash_cover.one_per_group(docs).collect()]
    texts = sorted((d, t) for d, t, _ in out if d is not None)
    assert texts == sorted([(1, a), (1, b), (4, c)])
    assert [t for d, t, _ in out if d is None] == [a]
    # which of the rows that share id and text stays does not depend on the partitions
    again = [tuple(r) for r in simhash_cover.one_per_group(docs.repartition(3)).collect()]
    assert sorted(out, key=repr) == sorted(again, key=repr)


def test_verdicts_under_one_id(spark):
    items = spark.createDataFrame([("q", " ".join(f"w{i}" for i in range(13)))], "item_id string, text string")
    rows = [(1, " ".join(f"w{i}" for i in range(13)), "q"), (1, "clean words only", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    assert [r.text for r in winnowing.without_benchmark(docs, items).collect()] == ["clean words only"]
