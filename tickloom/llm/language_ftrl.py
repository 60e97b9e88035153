"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. Weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample: each of a fixed number
of shards runs the learner over its rows, and the shards' weights are averaged. A coordinate whose
gradient sum stays under the l1 penalty has weight exactly zero. A second bounded sample, kept from
the fit, sets one temperature that divides all logits so that scores are calibrated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import fold, whole_text
from tickloom.llm.ngrams import Distinct, ngram_ids

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (1, 2, 3)
    bits: int = 15
    #: Bounds of the two samples: training rows with the smallest hash of their id.
    fit_rows: int = 8_000
    calibration_rows: int = 2_000
    #: Rows of every language that are in the samples at least, as far as it has them.
    floor_rows: int = 100
    shards: int = 8
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5


@dataclass
class Model:
    settings: Settings
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # language by n-gram, the last column is the bias
    temperature: float = 1.0


class Features:
    """TF-IDF of a text: log-scaled counts times idf, of unit length, and a constant bias."""

    def __init__(self, settings: Settings, idf: np.ndarray):
        self.settings, self.idf = settings, idf

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << self.settings.bits
        counts = np.bincount(ngram_ids(text, self.settings.sizes, self.settings.bits), None, size)
        ids = np.flatnonzero(counts)
        values = np.log1p(counts[ids]) * self.idf[ids]
        norm = np.sqrt((values**2).sum())
        return np.append(ids, size), np.append(values / (norm if norm else 1.0), 1.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def learn(
    rows: Iterable[tuple[str, int]], features: Features, classes: int, s: Settings
) -> np.ndarray:
    """Follow-the-regularised-leader over ``rows`` of (text, class)."""
    size = (1 << s.bits) + 1
    z, n = np.zeros((classes, size)), np.zeros((classes, size))

    def weights(ids):
        pull = z[:, ids]
        shrunk = np.sign(pull) * s.l1 - pull
        return np.where(
            np.abs(pull) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n[:, ids])) / s.alpha + s.l2)
        )

    prepared = [(*features(text), label) for text, label in rows]
    for _ in range(s.epochs):
        for ids, values, label in prepared:
            w = weights(ids)
            error = _softmax(w @ values)
            error[label] -= 1.0
            grad = error[:, None] * values[None, :]
            old = n[:, ids]
            new = old + grad**2
            z[:, ids] += grad - (np.sqrt(new) - np.sqrt(old)) / s.alpha * w
            n[:, ids] = new
    return weights(np.arange(size))


def _training(docs: DataFrame) -> DataFrame:
    """doc_id, lang and text of the rows that teach."""
    return docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(
        fold("doc_id", 4) != 2
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), whole_text().alias("text"))


def _chosen(rows: DataFrame, s: Settings) -> DataFrame:
    """Ids of the bounded sample: the first by hash, and of every language the first ``floor_rows``."""
    ids = rows.filter("doc_id IS NOT NULL").groupBy("lang", F.col("doc_id").alias("chosen_id")).agg(
        F.xxhash64("chosen_id").alias("turn")
    )
    first = ids.orderBy("turn", "chosen_id").limit(s.fit_rows + s.calibration_rows)
    of_lang = Window.partitionBy("lang").orderBy("turn", "chosen_id")
    floor = ids.withColumn("place", F.row_number().over(of_lang)).filter(F.col("place") <= s.floor_rows)
    return first.select("chosen_id").unionByName(floor.select("chosen_id")).distinct()


def _frequencies(rows: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """Texts with each n-gram, and their number."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distinct, sums = Distinct(s.bits), np.zeros((1 << s.bits) + 1, np.int64)
        for frame in frames:
            for text in frame["text"]:
                sums[distinct(ngram_ids(text, s.sizes, s.bits))] += 1
                sums[-1] += 1
        seen = np.flatnonzero(sums)
        yield pd.DataFrame({"id": seen, "n": sums[seen]})

    counted = rows.select(whole_text().alias("text")).mapInPandas(count, "id long, n long")
    table = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((1 << s.bits) + 1, np.int64)
    out[table["id"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return out[:-1], int(out[-1])


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from text and lang of documents outside the held-out fold (crc32 of the id mod 4 = 2).

    Rows with a null lang or text teach nothing; those with a null id count for the frequencies only. Without training rows the model knows no language.
    """
    rows = _training(docs)
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    frequencies, total = _frequencies(rows, settings)
    idf = np.log((1 + total) / (1 + frequencies)) + 1.0
    size = (1 << settings.bits) + 1
    model = Model(settings, languages, idf, np.zeros((len(languages), size)))
    if len(languages) < 2:
        return model
    chosen = _chosen(rows, settings)
    part = F.pmod(F.xxhash64(F.col("chosen_id"), F.lit("part")), F.lit(1 << 20))
    of_fit = settings.fit_rows / (settings.fit_rows + settings.calibration_rows)
    # at most fit_rows + calibration_rows rows, and floor_rows for each language, of three numbers
    chosen = chosen.select(
        "chosen_id",
        (part < int(of_fit * (1 << 20))).alias("fit"),
        F.pmod(part, F.lit(settings.shards)).alias("shard"),
    )
    # of rows that share an id the least is taken, so the sample is no larger than the ids
    met = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    sample = met.groupBy("chosen_id", "fit", "shard").agg(F.min(F.struct("lang", "text")).alias("row")).select(
        "fit", "shard", "row.text", "row.lang", F.xxhash64("chosen_id").alias("turn")
    )
    number = {name: k for k, name in enumerate(languages)}

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["turn", "lang", "text"])
        labels = [number[name] for name in shard["lang"]]
        w = learn(
            list(zip(shard["text"], labels, strict=True)),
            Features(settings, idf), len(languages), settings,
        )
        label, place = np.nonzero(w)
        return pd.DataFrame(
            {"label": label, "place": place, "weight": w[label, place], "rows": len(shard)}
        )

    found = (
        sample.filter("fit").groupBy("shard")
        .applyInPandas(fit, "label long, place long, weight double, rows long")
        .groupBy("label", "place").agg(F.sum(F.col("weight") * F.col("rows")).alias("weight"))
        .toPandas()
    )
    fitted = max(1, sample.filter("fit").count())
    model.weights[found["label"].to_numpy(int), found["place"].to_numpy(int)] = (
        found["weight"].to_numpy(float) / fitted
    )
    kept = sample.filter("NOT fit").select("lang", _logits(model)("text").alias("z")).toPandas()
    if len(kept):
        z = np.stack([np.asarray(v, float) for v in kept["z"]])
        model.temperature = calibrate(z, np.array([number[v] for v in kept["lang"]]))
    return model


def calibrate(z: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""

    def loss(log_t: float) -> float:
        scaled = z / np.exp(log_t)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        log_p = scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True))
        return -log_p[np.arange(len(labels)), labels].mean()

    low, high, golden = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _logits(model: Model):
    # weights of n-grams no language uses are not sent to the tasks
    used = np.flatnonzero(model.weights.any(axis=0))
    slim, size = model.weights[:, used], model.weights.shape[1]
    settings, idf = model.settings, model.idf.astype(np.float32)

    @F.pandas_udf("array<double>")
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(settings, idf.astype(float))
        weights = np.zeros((size, len(slim)))
        weights[used] = slim.T
        for texts in batches:
            out = []
            for text in texts:
                ids, values = features(text)
                out.append(values @ weights[ids])
            yield pd.Series(out)

    return logits


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    ``score`` is the calibrated probability of the predicted language. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if the model knows no language; equal
    logits give the first language in order. A repeated row is predicted again; a null id counts as
    empty text in the fold; an empty table gives no rows; other columns are ignored.
    """
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else None
    base = docs.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("readable"),
        whole_text().alias("text"),
    )
    if names is None:
        return base.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    z = F.transform("z", lambda v: v / F.lit(model.temperature))
    top = F.array_max(z)
    best = F.array_position(z, top).cast("int")
    spread = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
    return base.withColumn("z", _logits(model)("text")).select(
        "doc_id",
        "held_out",
        F.when(F.col("readable"), F.element_at(names, best)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("readable"), 1.0 / spread).otherwise(0.0).alias("score"),
    )
