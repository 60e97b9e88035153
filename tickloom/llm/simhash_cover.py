"""SimHash near-duplicates found through a covering family of bit masks.

Each fingerprint bit i gets a vector a(i) of ``radius + 1`` bits. For every nonzero vector v of that
length there is a table whose mask keeps the bits with odd <a(i), v>. Fingerprints that differ in at
most ``radius`` bits agree under some mask: the differing bits span a space of at most ``radius``
dimensions, so some nonzero v is orthogonal to all of them, and the mask of v drops them all. No
pair within the radius is missed, whatever the data. The vectors are dealt out so that each mask
keeps about half of the bits.

Equal fingerprints are merged first. A table's bucket yields a chain of links per component inside
it, never all pairs. A bucket above ``bucket_rows`` is divided before it is gathered: the bits its
mask dropped are cut into ``radius + 1`` blocks, two members within the radius agree on one of them,
and so every member goes to ``radius + 1`` buckets of longer keys, again without a miss.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import unions, whole_text
from tickloom.session import materialise

BITS = 64


def fingerprint(text: str, seed: int = 42) -> int:
    """Majority bits of the hashed 3-word shingles; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < 3:
        shingles: Iterable[bytes] = [b" ".join(words)]
        n = 1
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
        n = len(words) - 2
    ones = np.zeros(BITS, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    for at in range(0, n, 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and text_hash of every row. Null and empty texts give 0."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            bits = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
            yield pd.Series(bits.view(np.int64))

    return docs.select("doc_id", of_texts(whole_text()).alias("fp"), F.xxhash64(whole_text()).alias("text_hash"))


def masks(radius: int) -> list[int]:
    """One mask for each nonzero vector, as unsigned integers."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(BITS)]  # nonzero, each equally often
    return [
        sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() & 1)
        for v in range(1, size)
    ]


def blocks(mask: int, radius: int) -> list[int]:
    """The bits outside ``mask`` in ``radius + 1`` blocks."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << i for i in free[k :: radius + 1]) for k in range(radius + 1)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _in_tables(rows: DataFrame, family: list[int]) -> DataFrame:
    """Every fingerprint once per mask: fp, mask, key."""
    return rows.withColumn(
        "mask", F.explode(F.array(*[F.lit(_signed(m)) for m in family]))
    ).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def links(distinct: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """a, b: for each bucket, links that connect all members within ``radius`` of each other."""
    tabled = _in_tables(distinct.select("fp"), masks(radius))
    found = None
    deeper = {m: blocks(m, radius) for m in masks(radius)}
    while True:
        tabled = materialise(tabled, "buckets")
        sizes = tabled.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = materialise(sizes, "bucket_sizes")
        # a mask that leaves no block of bits to go by cannot be divided: its keys are whole
        large = sizes.filter(F.col("n") > bucket_rows)
        divisible = [m for m, parts in deeper.items() if all(parts)]
        large = large.filter(F.col("mask").isin([_signed(m) for m in divisible]))
        small = sizes.join(large.select("mask", "key"), ["mask", "key"], "left_anti")
        gathered = (
            tabled.join(small.select("mask", "key"), ["mask", "key"])
            .groupBy("mask", "key")
            .agg(F.collect_list("fp").alias("fps"))
        )
        part = gathered.select("fps").mapInPandas(_chains(radius), "a long, b long")
        found = part if found is None else found.unionByName(part)
        if large.isEmpty():
            return found.distinct()
        family = {m: [m | p for p in deeper[m]] for m in divisible}
        split = F.create_map(
            *[
                x
                for m, longer in family.items()
                for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in longer]))
            ]
        )
        tabled = (
            tabled.join(large.select("mask", "key"), ["mask", "key"])
            .select("fp", F.explode(F.element_at(split, F.col("mask"))).alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        )
        deeper = {k: blocks(k, radius) for longer in family.values() for k in longer}


def _chains(radius: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [chain(np.asarray(fps, np.int64), radius) for fps in frame["fps"]]
            pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def chain(fps: np.ndarray, radius: int, rows: int = 256) -> np.ndarray:
    """Links of each component's members to its smallest one, compared block by block."""
    bits = np.unique(fps).view(np.uint64)
    pairs = []
    for at in range(0, len(bits), rows):
        near = np.bitwise_count(bits[at : at + rows, None] ^ bits[None, at:]) <= radius
        i, j = np.nonzero(near)
        keep = i < j
        if keep.any():
            # within a block of rows only what joins new parts is kept
            sub = np.stack([i[keep] + at, j[keep] + at], axis=1)
            root = unions(sub, len(bits))
            member = np.flatnonzero(root != np.arange(len(bits)))
            pairs.append(np.stack([root[member], member], axis=1))
    if not pairs:
        return np.empty((0, 2), np.int64)
    root = unions(np.concatenate(pairs), len(bits))
    member = np.flatnonzero(root != np.arange(len(bits)))
    signed = bits.view(np.int64)
    return np.stack([signed[root[member]], signed[member]], axis=1)


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, of all nodes that have an edge.

    Alternates between linking every node to its smallest larger-or-equal neighbourhood member and
    the same for smaller ones, until nothing changes; each round is stored.
    """
    edges = materialise(edges.filter("a <> b"), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node are linked to the least of its neighbourhood
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        up = both.filter("b > a").join(low, "a")
        up = up.select(F.col("b").alias("a"), F.col("low").alias("b"))
        up = materialise(up.filter("a <> b").distinct(), "large_star")
        # small star: a node and its lower neighbours are linked to the least of them
        down = up.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        new = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        new = new.unionByName(low.select("a", F.col("low").alias("b")))
        edges = materialise(new.filter("a <> b").distinct(), "small_star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, radius: int = 3, bucket_rows: int = 20_000) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per input row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is
    the smallest doc_id that can be reached, the document itself included. Texts without words have
    fingerprint zero and are linked like any other; rows repeated under one id stay separate rows of
    one document; an empty table gives no rows. A null id never is the smallest, and its component
    has a null id only if no member has one. Columns other than doc_id and text are ignored.
    """
    return _grouped(docs, radius, bucket_rows).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id"
    )


def _grouped(docs: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """Rows of ``fingerprints`` with their component's root (a fingerprint) and smallest id."""
    prints = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = materialise(components(links(distinct, radius, bucket_rows)), "roots")
    # the smallest id of a component: every fingerprint under its root, a lone one under itself
    known = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = known.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp")


def hex16(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def one_per_group(docs: DataFrame, radius: int = 3, bucket_rows: int = 20_000) -> DataFrame:
    """One document of each component, all columns kept: the smallest id, then the least text hash.

    Rows with a null id stay. Two texts under one id are two documents: each stays if it is the
    first of its own component. Of rows that share id and text one stays, chosen by a hash of the
    whole row, so a task that is run again chooses the same.
    """
    numbered = docs.filter("doc_id IS NOT NULL")
    grouped = _grouped(numbered, radius, bucket_rows)
    first = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    kept = first.select("first.doc_id", "first.text_hash").distinct()
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    rows = numbered.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(whole_text()).alias("hash"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("turn"),
    )
    alike = Window.partitionBy("id", "hash").orderBy("turn")
    alone = rows.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    alone = alone.withColumn("place", F.row_number().over(alike)).filter("place = 1")
    return alone.select("row.*").unionByName(docs.filter("doc_id IS NULL"))
