"""Benchmark decontamination by winnowing.

A text is a sequence of words, hashed in k-grams. In every window of ``w`` consecutive k-grams the
least hash is kept as a fingerprint. A span of ``k + w - 1`` words that a document shares with a
benchmark item holds one whole window in both, and the least hash of equal windows is equal: each
shared span of that length meets in the join of fingerprints. With k = 4 and w = 10 the length is
13. Hits are then extended: those windows of a document whose fingerprint is a hit are compared with
the item's windows as whole 13-word spans, by two independent 64-bit hashes of all words.

Items with fewer words than a window are compared in the same way as one span of their own length,
for which each span of a document starts with the item's first word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import ascii_lower, whole_text
from tickloom.session import materialise


@dataclass(frozen=True)
class Settings:
    #: Words of a k-gram and k-grams of a window; spans of k + w - 1 words are guaranteed.
    k: int = 4
    w: int = 10
    #: A document is contaminated if at least one in so many of its words is hit.
    share: int = 20

    @property
    def span(self) -> int:
        return self.k + self.w - 1


# Fixed value: what parts words.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEEDS = (1, 2)


def words(text: Column) -> Column:
    """Maximal runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(text), _BREAK, -1), lambda x: x != "")


def word_hashes(text: Column, seed: int = 0) -> Column:
    return F.transform(words(text), lambda x: F.xxhash64(x, F.lit(seed)))


def _shifted(items: Column, by: int) -> Column:
    return F.slice(items, F.lit(by + 1), F.greatest(F.size(items) - by, F.lit(0)))


def _joined(items: Column, other: Column, by: int) -> Column:
    """Element i is the hash of items[i] and other[i + by]; the last ones hash what there is."""
    return F.zip_with(items, _shifted(other, by), lambda a, b: F.xxhash64(a, b))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(items: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` items, by doubling: one array pass per binary digit."""
    if length == 1:
        return items
    half = length // 2
    doubled = _let(spans(items, half), lambda a: _joined(a, a, half))
    if length % 2 == 0:
        return doubled
    return _let(items, lambda a: _joined(_let(spans(a, half), lambda h: _joined(h, h, half)), a, length - 1))


def least(items: Column, length: int) -> Column:
    """The least of each ``length`` consecutive items, by doubling."""
    if length == 1:
        return items
    half = 1
    while half * 2 <= length:
        half *= 2
    if half == length:
        return _let(least(items, half // 2), lambda a: _lower(a, half // 2))
    return _let(least(items, half), lambda a: _lower(a, length - half))


def _lower(items: Column, by: int) -> Column:
    return F.zip_with(items, _shifted(items, by), lambda a, b: F.least(a, b))


def window_prints(hashes: Column, settings: Settings) -> Column:
    """The fingerprint of each whole window, in the order of the windows."""
    whole = F.greatest(F.size(hashes) - (settings.span - 1), F.lit(0))
    return F.slice(least(spans(hashes, settings.k), settings.w), F.lit(1), whole)


def _item_spans(items: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Spans to look for: item_id, print, a, b of whole windows; item_id, size, a, b of shorter."""
    base = items.select(
        "item_id", *[word_hashes(whole_text(), s).alias(f"h{s}") for s in (0, *SEEDS)]
    ).withColumn("size", F.size("h0"))
    windows = base.filter(F.col("size") >= settings.span).select(
        "item_id",
        F.explode(
            F.arrays_zip(
                window_prints(F.col("h0"), settings).alias("print"),
                _whole(F.col("h1"), settings.span).alias("a"),
                _whole(F.col("h2"), settings.span).alias("b"),
            )
        ).alias("x"),
    )
    short = base.filter((F.col("size") > 0) & (F.col("size") < settings.span))
    return (
        windows.select("item_id", "x.print", "x.a", "x.b").distinct(),
        short.select(
            "item_id", "size", F.element_at("h0", 1).alias("first"),
            *[_fold(F.col(f"h{s}")).alias(name) for s, name in zip(SEEDS, "ab", strict=True)],
        ).distinct(),
    )


def _whole(hashes: Column, length: int) -> Column:
    whole = F.greatest(F.size(hashes) - (length - 1), F.lit(0))
    return F.slice(spans(hashes, length), F.lit(1), whole)


def _fold(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: F.xxhash64(acc, h))


def _same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, text_hash), null ids included; the key columns are those of ``left``."""
    right = right.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return left.join(right, on, how).drop("_id", "_hash")


def contamination(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Words of each document that stand inside a benchmark span.

    Columns: doc_id, text_hash, n_words, n_hit, n_items (items with spans found), items_sha256 (of
    their ids, sorted as strings and comma-joined), contaminated. One row per row of ``docs``; null
    and empty texts have no words, and are never contaminated; rows with the same id and text get
    the same result, as do rows with a null id. Items without words or with a null text find
    nothing; repeated items count by their id. Other columns are ignored.
    """
    windows, short = _item_spans(items.select("item_id", "text"), settings)
    windows, short = materialise(windows, "item_windows"), materialise(short, "item_short")
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    sketch = materialise(
        keyed.select("doc_id", "text_hash", word_hashes(F.col("text")).alias("h"))
        .select(
            "doc_id", "text_hash", F.size("h").cast("long").alias("n_words"),
            F.array_distinct(window_prints(F.col("h"), settings)).alias("prints"),
        ),
        "sketches",
    )

    # fingerprints shared with any item, then the windows behind them as whole spans
    shared = (
        sketch.select("doc_id", "text_hash", F.explode("prints").alias("print"))
        .join(windows.select("print").distinct(), "print")
        .groupBy("doc_id", "text_hash").agg(F.collect_set("print").alias("hits"))
    )
    shared = materialise(shared, "shared_prints")
    found = _same(keyed, shared).select(
        "doc_id", "text_hash", "hits",
        *[word_hashes(F.col("text"), s).alias(f"h{s}") for s in (0, *SEEDS)],
    ).select(
        "doc_id", "text_hash",
        F.posexplode(
            F.arrays_zip(
                window_prints(F.col("h0"), settings).alias("print"),
                _whole(F.col("h1"), settings.span).alias("a"),
                _whole(F.col("h2"), settings.span).alias("b"),
                F.transform(
                    window_prints(F.col("h0"), settings),
                    lambda p: F.array_contains(F.col("hits"), p),
                ).alias("hit"),
            )
        ).alias("at", "x"),
    ).filter("x.hit").select(
        "doc_id", "text_hash", "at", F.col("x.a").alias("a"), F.col("x.b").alias("b")
    ).join(windows.select("item_id", "a", "b").distinct(), ["a", "b"]).select(
        "doc_id", "text_hash", "at", F.lit(settings.span).alias("size"), "item_id"
    )
    found = found.unionByName(_short_hits(keyed, short))

    # covered words: spans by start, each counted from the furthest end so far
    by_start = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    starts = found.groupBy("doc_id", "text_hash", "at").agg(F.max("size").alias("size"))
    reached = F.max(F.col("at") + F.col("size")).over(
        by_start.rowsBetween(Window.unboundedPreceding, -1)
    )
    fresh = F.col("at") + F.col("size") - F.greatest(F.col("at"), F.coalesce(reached, F.lit(0)))
    hit_words = (
        starts.withColumn("fresh", F.greatest(fresh, F.lit(0)))
        .groupBy("doc_id", "text_hash").agg(F.sum("fresh").alias("n_hit"))
    )
    hit_items = (
        found.select("doc_id", "text_hash", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hits = materialise(_same(hit_words, hit_items), "hits")
    none = F.array().cast("array<string>")
    return _same(sketch.select("doc_id", "text_hash", "n_words"), hits, "left").select(
        "doc_id", "text_hash", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
    ).withColumn(
        "contaminated",
        (F.col("n_hit") > 0) & (F.lit(settings.share) * F.col("n_hit") >= F.col("n_words")),
    )


def _short_hits(keyed: DataFrame, short: DataFrame) -> DataFrame:
    """Occurrences of items shorter than a window, one look-up per word and length in use."""
    lengths = sorted(r[0] for r in short.select("size").distinct().collect())  # below a window
    schema = "doc_id, text_hash, at, size, item_id"
    hashed = keyed.select(
        "doc_id", "text_hash", *[word_hashes(F.col("text"), s).alias(f"h{s}") for s in (0, *SEEDS)]
    )
    out = None
    for length in lengths:
        wanted = short.filter(F.col("size") == length)

        def run(name: str, n: int = length) -> Column:
            starts = F.sequence(F.lit(1), F.size(name) - (n - 1))
            return F.transform(starts, lambda i: _fold(F.slice(name, i, n)))

        at = hashed.filter(F.size("h0") >= length).select(
            "doc_id", "text_hash",
            F.posexplode(
                F.arrays_zip(F.col("h0").alias("first"), run("h1").alias("a"), run("h2").alias("b"))
            ).alias("at", "x"),
        )
        at = at.select("doc_id", "text_hash", "at", "x.first", "x.a", "x.b").join(
            wanted, ["first", "a", "b"]
        )
        part = at.select(*schema.split(", "))
        out = part if out is None else out.unionByName(part)
    if out is None:
        item = short.schema["item_id"].dataType
        out = keyed.limit(0).select(
            "doc_id", "text_hash", F.lit(0).alias("at"), F.lit(0).alias("size"),
            F.lit(None).cast(item).alias("item_id"),
        )
    return out


def without_benchmark(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names.

    Each row is judged by its text; rows that share an id do not share a verdict.
    """
    dirty = contamination(docs, items, settings).filter("contaminated")
    dirty = dirty.select(F.col("doc_id").alias("dirty_id"), F.col("text_hash").alias("dirty_hash")).distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(whole_text()).alias("hash")
    )
    same = F.col("id").eqNullSafe(F.col("dirty_id")) & (F.col("hash") == F.col("dirty_hash"))
    return rows.join(dirty, same, "left_anti").select("row.*")
