"""How sources differ in vocabulary within a language, ranked over cells of equal counts.

A term's share in a group (a source of a language) depends only on its count there, and its
divergence from the language only on the pair (group count, language count). So terms are grouped by
that pair, the measure is evaluated once per cell, cells of equal value are merged and ranked by
their cumulative multiplicity, and only the cells that reach into the top ranks are expanded to
terms, in UTF-8 order. Pairs of sources are compared in the same way over cells of (count in one,
count in the other).

Counts are gathered per task before anything moves, so a hot source costs its distinct terms, not its
occurrences. All arithmetic is on integers; products that may leave 64 bits are decimals.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import materialise

#: A-Z lower-cased, every other ASCII byte that is no letter a blank.
_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_COUNTS = "lang string, source string, term binary, n bigint, docs bigint"
_NAMES = [x.split()[0] for x in _COUNTS.split(", ")]
_SLICE = 1 << 22
#: Rows handed on at once.
_ROWS = 50_000


def _terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in slices of bounded size; a term is never cut."""
    at = 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            blank = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]").search(data, end)
            end = blank.start() if blank else len(data)
        yield data[at:end].translate(_BLANKED).split()
        at = end


def _counts_of(tokens: list[bytes], sizes: list[int], groups: list[int]) -> tuple[pa.Array, list[np.ndarray]]:
    """Term, and arrays of group, n, docs, of some documents: ``sizes`` of their terms, their ``groups``."""
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    # documents in the order of their groups: one sort by (term, document) has each (term, group) together
    of_doc = np.asarray(groups)
    order = np.argsort(of_doc, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    key = coded.indices.to_numpy().astype(np.int64) * len(order) + np.repeat(place, sizes)
    key.sort()
    term, doc = np.divmod(key, len(order))
    group = of_doc[order][doc]
    first = np.append(True, (term[1:] != term[:-1]) | (group[1:] != group[:-1]))
    starts = np.flatnonzero(first)
    n = np.diff(starts, append=len(key))
    docs = np.add.reduceat(np.append(True, key[1:] != key[:-1]).astype(np.int64), starts)
    return coded.dictionary.take(pa.array(term[starts])), [group[starts], n, docs]


def count_terms(docs: DataFrame, held: int = 1 << 23) -> DataFrame:
    """Partial counts of (lang, source, term): ``n`` occurrences in ``docs`` documents.

    Every (lang, source) of the input also has a row with a null term. Nulls read as empty. A task
    counts about ``held`` bytes of text together; a longer text than a slice is counted by itself.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], int] = {}
        tokens: list[bytes] = []
        sizes: list[int] = []
        groups: list[int] = []
        size = 0

        def rows(terms: pa.Array, group: np.ndarray, n: np.ndarray, docs: np.ndarray):
            names = [pa.array(x, pa.string()) for x in zip(*known, strict=True)]
            for at in range(0, len(n), _ROWS):
                to = slice(at, at + _ROWS)
                columns = [x.take(pa.array(group[to])) for x in names]
                columns += [terms[to], pa.array(n[to], pa.int64()), pa.array(docs[to], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

        def gathered():
            if tokens:
                terms, numbers = _counts_of(tokens, sizes, groups)
                yield from rows(terms, *numbers)
            for x in (tokens, sizes, groups):
                x.clear()

        for batch in batches:
            lang, source = (batch.column(k).to_pylist() for k in range(2))
            texts = batch.column(2).cast(pa.binary())
            for row, text in enumerate(texts):
                group, data = known.setdefault((lang[row], source[row]), len(known)), text.as_py()
                if len(data) > _SLICE:
                    alone: Counter = Counter()
                    for terms in _terms(data):
                        alone.update(terms)
                    n = np.fromiter(alone.values(), np.int64, len(alone))
                    yield from rows(pa.array(list(alone), pa.binary()), np.full(len(n), group), n, np.ones_like(n))
                    continue
                terms = data.translate(_BLANKED).split()
                if terms:
                    tokens += terms
                    sizes.append(len(terms))
                    groups.append(group)
                size += len(data)
                if size > held:
                    yield from gathered()
                    size = 0
        yield from gathered()
        none, zero = pa.nulls(len(known), pa.binary()), np.zeros(len(known), np.int64)
        if known:
            yield from rows(none, np.arange(len(known)), zero, zero)

    narrow = docs.select(
        *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source", "text")]
    )
    return narrow.mapInArrow(run, _COUNTS)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 2) / (total + 2 * terms)), exact; the caller has terms > 0."""
    wide = "decimal(38,0)"
    up = (count + F.lit(2)).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    down = total.cast(wide) + F.lit(2).cast(wide) * terms.cast(wide)
    whole = F.call_function("div", up, down.cast("decimal(20,0)"))
    return F.lit(1).cast("bigint") + whole.cast("bigint")


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 1 + 10^9, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_audit(docs: DataFrame, min_docs: int = 10, ranks: int = 10) -> DataFrame:
    """Rows of two parts, as in the module text: ``pair`` (all other sources) and ``term`` (top ranks).

    Terms are runs of letters (A-Z lower-cased; every character beyond ASCII counts as a letter). A
    language keeps the terms that ``min_docs`` of its documents have. Each row of ``docs`` is a
    document of its own, repeated and null ids included; null text, lang and source read as empty.
    Equal values are ordered by item, as UTF-8 bytes. A language without kept terms has pairs of
    value 0 and no terms; an empty table gives no rows; other columns are ignored.

    Columns: lang, source, part, item, value, rank.
    """
    counted = count_terms(docs).groupBy("lang", "source", "term")
    counts = materialise(
        counted.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts"
    )
    groups = counts.filter("term IS NULL").select("lang", "source")
    in_lang = counts.filter("term IS NOT NULL").groupBy("lang", "term")
    in_lang = in_lang.agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = in_lang.filter(F.col("docs") >= min_docs).drop("docs")
    occurring = materialise(counts.drop("docs").join(kept, ["lang", "term"]), "kept_counts")

    # a term has one row for each source that has it: sums over sources count it once by its share
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    totals = occurring.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = materialise(
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "lang_total", "v"]),
        "group_sizes",
    )
    return _pairs(occurring, sizes).unionByName(_top_terms(occurring, sizes, ranks))


def _pairs(occurring: DataFrame, sizes: DataFrame) -> DataFrame:
    """The summed divergence of each two sources of a language, ranked for both."""
    # of the sources that share a term, each two once; a term has as many entries as sources
    by_term = occurring.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("in_sources")
    )
    both = (
        by_term.select("lang", "in_sources", F.posexplode("in_sources").alias("i", "a"))
        .select(
            "lang", "a",
            F.explode(F.slice("in_sources", F.col("i") + 2, F.size("in_sources"))).alias("b"),
        )
        .groupBy("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"),
                 F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
        .agg(F.count("*").alias("m"))
    )
    both = materialise(both, "pair_cells")

    # every two sources of a language; the result has a row for each way round
    a = sizes.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "v")
    b = sizes.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = a.join(b, "lang").filter("a < b")
    key = ["lang", "a", "b"]
    # terms that one of the two has: by count in it, less those that the other has too
    one = occurring.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    only_a = pairs.select(*key).join(one.select("lang", F.col("source").alias("a"), "n", "m"), ["lang", "a"])
    only_b = pairs.select(*key).join(one.select("lang", F.col("source").alias("b"), "n", "m"), ["lang", "b"])
    zero = F.lit(0).cast("bigint")
    cells = both.unionByName(both.select(*key, "n_a", zero.alias("n_b"), (-F.col("m")).alias("m")))
    cells = cells.unionByName(both.select(*key, zero.alias("n_a"), "n_b", (-F.col("m")).alias("m")))
    cells = cells.unionByName(only_a.select(*key, F.col("n").alias("n_a"), zero.alias("n_b"), "m"))
    cells = cells.unionByName(only_b.select(*key, zero.alias("n_a"), F.col("n").alias("n_b"), "m"))
    cells = cells.groupBy(*key, "n_a", "n_b").agg(F.sum("m").alias("m"))
    # and the rest, which neither has
    seen = cells.groupBy(*key).agg(F.sum("m").alias("seen"))
    rest = pairs.join(seen, key, "left").filter("v > 0").select(
        *key, zero.alias("n_a"), zero.alias("n_b"), (F.col("v") - F.coalesce("seen", zero)).alias("m")
    )
    cells = cells.unionByName(rest).filter("m > 0").join(pairs, key)
    p = share(F.col("n_a"), F.col("total_a"), F.col("v"))
    q = share(F.col("n_b"), F.col("total_b"), F.col("v"))
    sums = cells.groupBy(*key).agg(F.sum(divergence(p, q) * F.col("m")).alias("value"))
    sums = materialise(
        pairs.select(*key).join(sums, key, "left").fillna(0, ["value"]), "pair_sums"
    )
    ways = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ways.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _top_terms(occurring: DataFrame, sizes: DataFrame, ranks: int) -> DataFrame:
    """The terms a source uses beyond its language's share, by divergence."""
    cell = ["lang", "source", "n", "lang_n"]
    cells = occurring.groupBy(*cell).agg(F.count("*").alias("m")).join(sizes, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("v"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    valued = cells.select(*cell, "m", p.alias("p"), q.alias("q")).filter("p > q")
    valued = materialise(
        valued.select(*cell, "m", divergence(F.col("p"), F.col("q")).alias("value")), "valued_cells"
    )
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # at most ``ranks`` values can reach into the top, as each has a term
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    best = merged.withColumn("place", F.row_number().over(group)).filter(F.col("place") <= ranks)
    before = (F.sum("m").over(group) - F.col("m")).alias("before")
    reached = best.select("lang", "source", "value", before).filter(F.col("before") < ranks)
    tied = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        occurring.join(valued.drop("m").join(reached, ["lang", "source", "value"]), cell)
        .select("lang", "source", "value", "term", "before", F.row_number().over(tied).alias("place"))
        .filter(F.col("place") <= ranks)
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
            "value", (F.col("before") + F.col("place")).cast("int").alias("rank"),
        )
        .filter(F.col("rank") <= ranks)
    )
