"""Secret scan: fixed patterns, and two character Markov models compared by likelihood.

One model is trained on random strings, the other on ordinary identifiers, both as smoothed bigram
frequencies of labelled samples. Every long run of key characters outside the patterns' matches is
scored by the sum over its bigrams of log P(random) - log P(ordinary); runs above a threshold are
spans of kind ``random``, and in the other runs the stretches that reach it, widened to whole tokens. Everything is DataFrame code: the ratios of the two models (a fixed number
of character pairs) become one literal array, and a text is scanned where it lies.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, UPPER, whole_text

# The patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

KEY_CHARS = UPPER + LOWER + "0123456789+/_.=-"
_RUN = "[A-Za-z0-9+/_.=-]"
_SPAN = "array<struct<start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Settings:
    #: Bound of the training sample: documents with the smallest hash of their id.
    sample_docs: int = 1_000
    #: Shorter runs are not scored, shorter words teach nothing.
    least_run: int = 20
    least_word: int = 6
    #: The ratio from which a run is called random, and its least mean per character pair.
    threshold: float = 12.0
    mean: float = 0.6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def positions(text: Column, pattern: str, block: int = 64) -> Column:
    """start, end (code points, end exclusive) and value of all matches from left to right.

    The texts between the matches give the distances. Sums run inside blocks and over block totals,
    so a text with very many matches does not copy one growing array again and again.
    """
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"),
            F.coalesce(F.length(match), F.lit(0)).alias("size"),
            match.alias("value"),
        ),
    )

    def width(of: Column) -> Column:
        return F.aggregate(of, F.lit(0), lambda s, x: s + x["gap"] + x["size"])

    def placed(items: Column, base: Column) -> Column:
        return F.aggregate(
            items,
            F.struct(base.alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["size"]).alias("end"),
                            x["value"].alias("value"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def bases(blocks: Column) -> Column:
        return F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, items: F.struct(
                (acc["at"] + width(items)).alias("at"),
                F.concat(acc["out"], F.array(acc["at"])).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def in_blocks(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / F.lit(block)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda k: F.slice(items, k * block + 1, F.lit(block))
        )

    found = _let(
        _let(pieces, in_blocks),
        lambda blocks: F.flatten(F.zip_with(blocks, bases(blocks), placed)),
    )
    found = F.filter(found, lambda x: x["value"].isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _named(spans: Column, kind: int) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"),
            x["value"].alias("value"),
        ),
    )


def base_spans(text: Column) -> Column:
    """start, kind (place in KINDS), end, value of the patterns' matches, by start and kind."""
    assign = F.filter(
        positions(text, ASSIGN),
        lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= 6,
    )
    return F.sort_array(
        F.concat(
            _named(assign, 0),
            _named(positions(text, ACCESS), 1),
            _named(positions(text, HEX), 2),
        )
    )


def labelled_samples(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """value and label (1 random, 0 ordinary), from a bounded sample of documents.

    Random strings are what the patterns find, and digests of the sampled texts written as hex,
    base64 and capitals; ordinary ones are the texts' other words.
    """
    chosen = (
        docs.select(F.col("doc_id").alias("chosen_id"))
        .filter("chosen_id IS NOT NULL")
        .distinct()
        .orderBy(F.xxhash64("chosen_id"), "chosen_id")
        .limit(settings.sample_docs)
    )
    # of rows that share an id the least text is taken
    all_texts = docs.select(F.col("doc_id").alias("text_id"), whole_text().alias("text"))
    texts = (
        all_texts.join(F.broadcast(chosen), F.col("text_id") == F.col("chosen_id"))
        .groupBy("chosen_id").agg(F.min("text").alias("text")).select("text")
    )
    digest = F.sha2("text", 256)
    base64 = F.base64(F.unhex(digest))
    drawn = F.array(
        digest, base64, F.upper(F.regexp_replace(base64, "[^A-Za-z0-9]", "")),
        F.substring(F.sha2(F.reverse("text"), 256), 1, 40),
    )
    patterns = f"{ASSIGN}|{ACCESS}|{HEX}"
    words = F.regexp_extract_all(
        F.regexp_replace("text", patterns, " "), F.lit(f"{_RUN}{{{settings.least_word},}}"), F.lit(0)
    )
    secret = F.transform(
        base_spans(F.col("text")),
        lambda x: F.when(x["kind"] == 0, F.regexp_extract(x["value"], ASSIGN, 2)).otherwise(
            x["value"]
        ),
    )
    random = texts.select(F.explode(F.concat(drawn, secret)).alias("value"), F.lit(1).alias("label"))
    return random.unionByName(
        texts.select(F.explode(words).alias("value"), F.lit(0).alias("label"))
    )


def train(samples: DataFrame) -> list[float]:
    """log P(random) - log P(ordinary) of each pair of key characters, from value and label.

    Add-one smoothing, each row of the transition matrix by itself. Null values and values of one
    character teach nothing; without samples all ratios are 0.
    """
    size = len(KEY_CHARS)
    value = F.coalesce(F.col("value").cast("string"), F.lit(""))
    pairs = samples.filter(F.length(value) > 1).select(
        "label",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.substring(value, i, 2))
        ).alias("pair"),
    )
    # at most two rows for each pair of key characters
    counted = (
        pairs.filter(F.col("pair").rlike(f"^{_RUN}{_RUN}$"))
        .groupBy("label", "pair").count().collect()
    )
    place = {c: i for i, c in enumerate(KEY_CHARS)}
    seen = {k: [[1] * size for _ in range(size)] for k in (0, 1)}
    for label, (a, b), n in counted:
        if label in seen:
            seen[label][place[a]][place[b]] += n
    return [
        math.log(r / sum(random)) - math.log(o / sum(ordinary))
        for random, ordinary in zip(seen[1], seen[0], strict=True)
        for r, o in zip(random, ordinary, strict=True)
    ]


def ratio(value: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a string of key characters."""
    table = F.lit(model)
    codes = F.transform(
        F.sequence(F.lit(1), F.length(value)),
        lambda i: F.instr(F.lit(KEY_CHARS), F.substring(value, i, 1)),
    )
    return F.aggregate(
        codes,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last")),
        lambda acc, c: F.struct(
            F.when(acc["last"] == 0, F.lit(0.0))
            .otherwise(
                acc["sum"]
                + F.element_at(table, (acc["last"] - 1) * len(KEY_CHARS) + c)
            )
            .alias("sum"),
            c.alias("last"),
        ),
        lambda acc: acc["sum"],
    )


def stretches(value: Column, model: list[float], settings: Settings) -> Column:
    """start, end of the stretches of a string of key characters that are random by themselves.

    One walk adds up the ratios less the least mean. A stretch ends where the sum is used up or has
    fallen by the threshold since its peak, and reaches to the peak, so its mean is never too small.
    It is widened to the separators around it and counts from ``least_run`` characters on.
    """
    table, places = F.lit(model), "array<struct<start:int,end:int>>"
    codes = F.transform(
        F.sequence(F.lit(1), F.length(value)),
        lambda i: F.instr(F.lit(KEY_CHARS), F.substring(value, i, 1)),
    )

    def state(last, at, now, start, best, end, out) -> Column:
        named = {"last": last, "at": at, "now": now, "start": start, "best": best, "end": end, "out": out}
        return F.struct(*[c.alias(k) for k, c in named.items()])

    def closed(acc: Column) -> Column:
        total = acc["best"] + settings.mean * (acc["end"] - acc["start"] - 1)
        found = F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
        return F.when(
            (acc["best"] > 0) & (total >= settings.threshold), F.concat(acc["out"], found)
        ).otherwise(acc["out"])

    def step(acc: Column, code: Column) -> Column:
        ratio_here = F.when(acc["last"] == 0, F.lit(0.0)).otherwise(
            F.element_at(table, (acc["last"] - 1) * len(KEY_CHARS) + code) - settings.mean
        )

        def moved(now: Column) -> Column:
            over = (now <= 0) | (now < acc["best"] - settings.threshold)
            peak = now > acc["best"]
            return F.when(
                over,
                state(code, acc["at"] + 1, F.lit(0.0), acc["at"], F.lit(0.0), acc["at"], closed(acc)),
            ).otherwise(
                state(
                    code, acc["at"] + 1, now, acc["start"],
                    F.when(peak, now).otherwise(acc["best"]),
                    F.when(peak, acc["at"] + 1).otherwise(acc["end"]), acc["out"],
                )
            )

        return _let(acc["now"] + ratio_here, moved)

    zero = F.lit(0)
    found = F.aggregate(
        codes,
        state(zero, zero, F.lit(0.0), zero, F.lit(0.0), zero, F.array().cast(places)),
        step,
        closed,
    )

    def widened(x: Column) -> Column:
        left = F.regexp_extract(F.substring(value, F.lit(1), x["start"]), r"[^/.=_-]*$", 0)
        right = F.regexp_extract(F.substring(value, x["end"] + 1, F.length(value)), r"^[^/.=_-]*", 0)
        return F.struct(
            (x["start"] - F.length(left)).alias("start"), (x["end"] + F.length(right)).alias("end")
        )

    return F.filter(
        F.array_distinct(F.transform(found, widened)),
        lambda x: x["end"] - x["start"] >= settings.least_run,
    )


def _blanked(text: Column, spans: Column) -> Column:
    """The text with the spans (by start) as blanks, so that places stay."""
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(
            spans,
            F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
            lambda acc, x: F.struct(
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0))),
                    F.repeat(
                        F.lit(" "),
                        F.greatest(x["end"] - F.greatest(acc["at"], x["start"]), F.lit(0)),
                    ),
                ).alias("out"),
                F.greatest(acc["at"], x["end"]).alias("at"),
            ),
            lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
        )
    )


def find_secrets(
    docs: DataFrame, model: list[float] | None = None, settings: Settings = Settings()
) -> DataFrame:
    """All columns of ``docs`` under ``doc``, and ``spans``: start, kind, end, value.

    Kinds are places in KINDS. Spans of the patterns are kept as they are, those of different kinds
    may overlap; runs are scored where they lie outside of them. A run that is not random as a whole is
    searched for random stretches. Null and empty texts have no
    spans; every row is scanned by itself, so repeated rows, ties and null ids need no rule. Without
    ``model`` one is trained on ``labelled_samples(docs)``.
    """
    if model is None:
        model = train(labelled_samples(docs, settings))
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    base = docs.select(F.struct("*").alias("doc")).withColumn("base", base_spans(text))
    base = base.withColumn("blanked", _blanked(text, F.col("base")))
    runs = positions(F.col("blanked"), f"{_RUN}{{{settings.least_run},}}")

    def random_parts(x: Column) -> Column:
        least = F.greatest(
            F.lit(settings.threshold), F.lit(settings.mean) * (F.length(x["value"]) - 1)
        )
        inside = F.transform(
            stretches(x["value"], model, settings),
            lambda p: F.struct(
                (x["start"] + p["start"]).alias("start"),
                (x["start"] + p["end"]).alias("end"),
                F.substring(x["value"], p["start"] + 1, p["end"] - p["start"]).alias("value"),
            ),
        )
        return F.when(ratio(x["value"], model) >= least, F.array(x)).otherwise(inside)

    parts = F.flatten(F.transform(runs, random_parts))
    return base.withColumn("random", _named(parts, 3)).select(
        "doc", F.sort_array(F.concat("base", "random")).alias("spans")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"]),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of ``find_secrets``."""

    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(_joined(F.filter("spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        n(3).alias("n_random"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]", settings: Settings = Settings()) -> DataFrame:
    """The documents with every span (overlapping ones joined) replaced by ``mark``.

    Columns stay; ``n_chars``, where there is one, is counted anew for changed texts. Each row is
    treated by itself, repeated and null ids included; a null text stays null.
    """
    text = F.col("doc.text")
    cut = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.when(
                x["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, x["start"] - acc["at"]),
                    F.lit(mark),
                ),
            ).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    found = find_secrets(docs, None, settings)
    clean = F.when(F.size("spans") == 0, text).otherwise(cut)
    columns = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    columns["text"] = F.col("clean")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(
            F.size("spans") == 0, F.col("doc.n_chars")
        ).otherwise(F.length("clean").cast(kind))
    return found.withColumn("clean", clean).select(*[c.alias(k) for k, c in columns.items()])
