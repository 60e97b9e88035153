"""I-Match fingerprints: hashes of the mid-frequency terms under several randomised lexicons.

A term counts if its document frequency lies in a band (inverse document frequency is its
logarithm). The lexicon of such terms is exact, and small at any corpus size: every document holds
only so many distinct terms, so at most ``mean distinct terms / low`` terms can reach the lower
bound. Terms are first counted in hash buckets; only terms of buckets that reach the bound are
counted one by one. A document's distinct lexicon terms, in lexicon order, are hashed once per
randomised subset of the lexicon. Two documents that differ in a few terms agree on the subsets
that leave those terms out, and the share of equal hashes is their likeness.

A text most of whose terms lie outside the band (near copies that make up a large part of the rows,
a rare language, very short texts) would be judged by stray words, so each fingerprint has a second
family: the same subsets over all distinct terms. Whether the band family is filled depends on the
text alone; two texts that both have it are compared by it, all others by the second.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import numbered_parts, whole_text
from tickloom.session import materialise


@dataclass(frozen=True)
class Settings:
    #: Band of document frequency as a share of all documents.
    low: float = 0.01
    high: float = 0.1
    #: Subsets: the lexicon is dealt at random (by bits of the term's hash from ``shift`` on) into
    #: ``parts``, of which the first ``used`` count. Small parts serve long texts, large ones short.
    levels: tuple[tuple[int, int, int], ...] = ((20, 8, 8), (28, 64, 64), (40, 512, 32))
    bucket_bits: int = 18
    #: The band speaks for a text from so many terms and this share of its distinct terms on.
    least_terms: int = 8
    least_share: float = 0.125

    @property
    def subsets(self) -> int:
        return sum(used for _, _, used in self.levels)


#: The hash of an array without elements (the seed).
EMPTY = 42


def term_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, settings: Settings = Settings()) -> list[int]:
    """Hashes of all terms in the band, ascending. Counts cover every document."""
    hashed = docs.select(term_hashes(whole_text()).alias("terms"))
    total = docs.count()
    low, high = settings.low * total, settings.high * total
    mask = F.lit((1 << settings.bucket_bits) - 1)
    buckets = (
        hashed.select(
            F.explode(
                F.array_distinct(F.transform("terms", lambda t: t.bitwiseAND(mask).cast("int")))
            ).alias("bucket")
        )
        .groupBy("bucket").count().filter(F.col("count") >= low).select("bucket")
    )
    buckets = materialise(buckets, "term_buckets")
    terms = hashed.select(F.explode(F.array_distinct("terms")).alias("term")).withColumn(
        "bucket", F.col("term").bitwiseAND(mask).cast("int")
    )
    # not more buckets than 2 ** bucket_bits, each an integer
    counted = (
        terms.join(F.broadcast(buckets), "bucket").groupBy("term").count()
        .filter((F.col("count") >= low) & (F.col("count") <= high))
    )
    return sorted(r[0] for r in counted.select("term").collect())


def _by_subset(found: Column, settings: Settings) -> Column:
    """One hash for each subset; large levels are dealt in two steps, which saves most tests."""

    def dealt(of: Column, shift: int, parts: int) -> list[Column]:
        def part(k: int) -> Column:
            # one mask in place: two steps a term, not three
            bits, wanted = F.lit((parts - 1) << shift), F.lit(k << shift)
            return F.filter(of, lambda t: t.bitwiseAND(bits) == wanted)

        return [part(k) for k in range(parts)]

    def level(shift: int, parts: int, used: int) -> Column:
        fine = min(parts, 8)

        def hashes(of: Column) -> Column:
            return F.array(*[F.hash(x) for x in dealt(of, shift, fine)])

        if parts == fine:
            return F.slice(hashes(found), 1, used)
        first = F.filter(
            found, lambda t: t.bitwiseAND(F.lit((parts - 1) << shift)) < F.lit(used << shift)
        )
        coarse = F.transform(
            F.array(first),
            lambda f: F.array(*dealt(f, shift + 3, parts // fine)[: -(-used // fine)]),
        )
        return F.slice(F.flatten(F.transform(F.element_at(coarse, 1), hashes)), 1, used)

    return F.concat(*[level(*x) for x in settings.levels])


def fingerprint(text: Column, terms: list[int], settings: Settings = Settings()) -> Column:
    """One hash for each subset of the band, then one for each subset of all terms, as integers.

    ``EMPTY`` stands where no term falls in, and in the whole first family of a text for which the
    band does not speak. A text without any term has the hash of itself in the second family.
    """
    own = F.sort_array(F.array_distinct(term_hashes(text)))
    # a set of constants is asked once for each term of the text, whatever the lexicon's size; both
    # ascend, so the band keeps the order of the lexicon
    in_band = F.transform(
        F.array(own),
        lambda t: F.struct(t.alias("all"), F.filter(t, lambda x: x.isin(terms)).alias("band")),
    )

    def families(found: Column) -> Column:
        enough = F.size(found["band"]) >= F.greatest(
            F.lit(float(settings.least_terms)), settings.least_share * F.size(found["all"])
        )
        no_band = F.array_repeat(F.lit(EMPTY), settings.subsets)
        whole = F.array_repeat(F.hash(text), settings.subsets)
        return F.concat(
            F.when(enough, _by_subset(found["band"], settings)).otherwise(no_band),
            F.when(F.size(found["all"]) == 0, whole).otherwise(_by_subset(found["all"], settings)),
        )

    return F.element_at(F.transform(in_band, families), 1)


def written(parts: Column) -> Column:
    """A fingerprint as text: eight hex digits for each subset."""
    digits = lambda p: F.lpad(F.hex(p.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.lower(F.array_join(F.transform(parts, digits), ":"))


def likeness(a: Column, b: Column, settings: Settings = Settings()) -> Column:
    """Share of equal hashes among the subsets in which either text has a term.

    The subsets of the band if both texts have terms there, else those of all terms.
    """
    n = settings.subsets

    def banded(x: Column) -> Column:
        return F.exists(F.slice(x, 1, n), lambda p: p != EMPTY)

    start = F.when(banded(a) & banded(b), F.lit(1)).otherwise(F.lit(n + 1))
    both = F.zip_with(
        F.slice(a, start, n), F.slice(b, start, n),
        lambda x, y: F.struct(x.alias("x"), y.alias("y")),
    )
    filled = F.filter(both, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY))
    return F.element_at(
        F.transform(
            F.array(filled),
            lambda f: F.size(F.filter(f, lambda p: p["x"] == p["y"])) / F.size(f),
        ),
        1,
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """id, prev_id, prev_half: the ids as a ring in ascending order.

    ``prev_half`` is half the length of the text before. Only ids and lengths are sorted.
    """
    sizes = docs.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.length(whole_text())).alias("n")
    )
    lined = numbered_parts(sizes, [F.col("id")], "ring")
    ends = lined.groupBy("part").agg(
        F.max_by("id", "row").alias("last_id"), F.max_by("n", "row").alias("last_n")
    )
    # one row for each partition of the sort
    order, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    last = F.struct("last_id", "last_n")
    ends = ends.select(
        "part", F.coalesce(F.lag(last).over(order), F.last(last).over(whole)).alias("before")
    )
    inside = Window.partitionBy("part").orderBy("row")
    here = F.lag(F.struct(F.col("id").alias("last_id"), F.col("n").alias("last_n"))).over(inside)
    return lined.withColumn("here", here).join(ends, "part").select(
        "id",
        F.coalesce("here", "before")["last_id"].alias("prev_id"),
        F.floor(F.coalesce("here", "before")["last_n"] / 2).cast("int").alias("prev_half"),
    )


def compare_edited(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fingerprints of all texts and of their edited forms.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next document in ascending order of doc_id (the first document follows the last). Columns:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is empty; a text without any term is its own fingerprint, so such texts are alike if
    equal. A null id comes first in the order. Rows that share an id are edited
    each by itself, by half of its own length, and count as one neighbour (the least text). Other columns
    are ignored; an empty table gives no rows; a single document follows itself.
    """
    terms = lexicon(docs, settings)
    # only texts and ids move to their place in the ring; a fingerprint is worked out on either side
    # of the next exchange rather than carried through both
    texts = docs.select("doc_id", whole_text().alias("text"))
    ring = materialise(neighbours(docs), "neighbours")
    parts = fingerprint(F.col("text"), terms, settings).alias("parts")
    placed = texts.join(ring, F.col("doc_id").eqNullSafe(F.col("id"))).select(
        "prev_id", F.left("text", F.col("prev_half")).alias("head"), parts
    )
    heads = placed.groupBy("prev_id").agg(F.min(F.struct("head", "parts")).alias("next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next.head"), half))
    both = texts.join(heads, F.col("doc_id").eqNullSafe(F.col("prev_id"))).select(
        "doc_id", n.cast("long").alias("n_chars"), parts, F.col("next.parts").alias("next_parts"),
        edited.alias("edited"),
    )
    both = both.withColumn("edited_parts", fingerprint(F.col("edited"), terms, settings))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("parts")).alias("fingerprint"),
        written(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts"), settings).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts"), settings).alias("near_next"),
    )
