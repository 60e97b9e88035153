"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed character n-gram. Its ratio is

    r = log(share of toxic training texts with it / share of the others with it)

with the smoothing split in proportion to the class sizes, so an n-gram never seen has r = 0. The
classifier is a logistic regression on the features times r: evidence that the counts show strongly
is cheap to weigh, noise is expensive. N-grams with a small ratio or few texts carry no weight.

Counting and featurising run as Spark tasks. Training is bounded by ``train_rows`` labelled rows;
what reaches the driver is the counts of n-grams in enough texts and the selected features of those
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fold, whole_text
from tickloom.llm.ngrams import Distinct, ngram_ids
from tickloom.session import materialise


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (3, 4, 5, 6)
    #: Slots of the n-grams, well above their number, so that frequent ones do not cover rare ones.
    bits: int = 22
    #: Bound of the training sample: labelled rows with the smallest hash of their id.
    train_rows: int = 16_000
    smoothing: float = 3.0
    least_texts: int = 4
    least_ratio: float = 2.0
    penalty: float = 0.01
    steps: int = 400
    #: A text is rejected from this score on.
    threshold: float = 0.7


@dataclass
class Model:
    settings: Settings
    bias: float
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.settings.bits)
        out[self.ids] = self.weights
        return out


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """text and y of the bounded sample, outside the held-out fold.

    An id that is labelled more than once is toxic if any label says so; of rows that share an id
    the least text is taken. So the sample has at most ``train_rows`` rows.
    """
    chosen = (
        labels.select(
            F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("y"),
            fold("doc_id", 3).alias("fold"),
        )
        .filter("fold <> 1 AND y IN (0, 1) AND label_id IS NOT NULL")
        .groupBy("label_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(settings.train_rows)
    )
    texts = docs.select(F.col("doc_id").alias("text_id"), whole_text().alias("text"))
    # at most train_rows rows of two numbers
    met = texts.join(F.broadcast(chosen), F.col("text_id") == F.col("label_id"))
    return met.groupBy("label_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).select("text", "y")


def _counts(rows: DataFrame, settings: Settings) -> DataFrame:
    """Texts with each n-gram of enough texts, by class; id -1 counts the texts themselves."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distinct = Distinct(settings.bits)
        sums = np.zeros((2, (1 << settings.bits) + 1), np.int32)
        for frame in frames:
            for text, y in frame.itertuples(index=False):
                sums[y, distinct(ngram_ids(text, settings.sizes, settings.bits))] += 1
                sums[y, -1] += 1
        seen = np.flatnonzero(sums.any(axis=0))
        ids = np.where(seen == 1 << settings.bits, -1, seen)
        yield pd.DataFrame({"id": ids, "others": sums[0, seen], "toxic": sums[1, seen]})

    counted = rows.mapInPandas(count, "id long, others long, toxic long")
    summed = counted.groupBy("id").agg(
        F.sum("others").alias("others"), F.sum("toxic").alias("toxic")
    ).filter(
        (F.col("id") < 0) | (F.col("others") + F.col("toxic") >= settings.least_texts)
    )
    return materialise(summed, "ngram_counts")


def _fit(groups: list[np.ndarray], y: np.ndarray, r: np.ndarray, s: Settings):
    """Accelerated gradient descent on the mean log loss; returns weights of raw features, bias."""
    sizes = np.fromiter(map(len, groups), np.int64, len(groups))
    flat = np.concatenate(groups) if sizes.sum() else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(groups)), sizes)
    scale, n = r[flat], len(y)
    w, b = np.zeros(len(r)), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    wv, bv, pace = w.copy(), b, 1.0
    # a step that no curvature exceeds: a quarter of the largest squared row norm, by row share
    norms = np.bincount(owner, scale**2, n)
    rate = 1.0 / (0.25 * max(np.percentile(norms, 99), 1.0) / 4 + s.penalty / n)
    for _ in range(s.steps):
        z = np.bincount(owner, wv[flat] * scale, n) + bv
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        grad = np.bincount(flat, error[owner] * scale, len(r)) + s.penalty / n * wv
        nw, nb = wv - rate * grad, bv - min(rate, 1.0) * error.sum()
        nxt = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        wv, bv = nw + (pace - 1) / nxt * (nw - w), nb + (pace - 1) / nxt * (nb - b)
        w, b, pace = nw, nb, nxt
    return w * r, b


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled documents (``labels``: doc_id, toxic) outside the held-out fold.

    Without rows of both classes the model is the smoothed share of toxic rows.
    """
    # read for the counts and for the fit
    rows = materialise(training_rows(docs, labels, settings), "toxic_sample")
    counts = _counts(rows, settings)
    total = counts.filter("id < 0").agg(F.sum("others"), F.sum("toxic")).first()
    others, toxic = int(total[0] or 0), int(total[1] or 0)
    if not others or not toxic:
        share = (toxic + 1) / (others + toxic + 2)
        return Model(settings, float(np.log(share / (1 - share))))
    n = others + toxic
    p = (F.col("toxic") + settings.smoothing * toxic / n) / toxic
    q = (F.col("others") + settings.smoothing * others / n) / others
    telling = counts.filter("id >= 0").select("id", F.log(p / q).alias("r"))
    # the few n-grams that tell the classes apart
    kept = telling.filter(F.abs("r") >= settings.least_ratio).orderBy("id").toPandas()
    ids, r = kept["id"].to_numpy(np.int64), kept["r"].to_numpy(float)

    def select(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distinct = Distinct(settings.bits)
        # built in the task: only the ids travel
        place = np.full(1 << settings.bits, -1, np.int32)
        place[ids] = np.arange(len(ids))
        for frame in frames:
            kept = []
            for text in frame["text"]:
                at = place[distinct(ngram_ids(text, settings.sizes, settings.bits))]
                kept.append(at[at >= 0])
            yield pd.DataFrame({"y": frame["y"], "at": kept})

    sample = rows.mapInPandas(select, "y int, at array<int>").toPandas()
    groups = [np.asarray(a, np.int64) for a in sample["at"]]
    weights, bias = _fit(groups, sample["y"].to_numpy(float), r, settings)
    return Model(settings, bias, ids, weights)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A function of a text column: the probability that the text is toxic."""
    settings = model.settings

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, distinct = model.dense(), Distinct(settings.bits)
        for texts in batches:
            ids = (distinct(ngram_ids(t, settings.sizes, settings.bits)) for t in texts)
            z = np.fromiter((weights[i].sum() for i in ids), float, len(texts)) + model.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return score


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts get the score of a text without n-grams; a repeated row is scored again;
    a null id counts as empty text in the fold; an empty table gives no rows; other columns are
    ignored.
    """
    return docs.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        scorer(model)(whole_text()).alias("score"),
    ).withColumn("predicted", (F.col("score") >= model.settings.threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not rejected, with all their columns, whatever their names.

    Each row is judged by itself, repeated and null ids included; a null text scores as empty.
    """
    model = train(docs, labels, settings)
    return docs.filter(scorer(model)(whole_text()) < settings.threshold)
