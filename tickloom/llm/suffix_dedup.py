"""Removal of long repeated byte strings, by suffix arrays over content-defined shards.

Every window of ``span`` bytes is assigned to the least hash among its grams (the leftmost one), its
anchor, and to a block by its distance from it. Neighbouring windows of one anchor and block travel as
one region, the bytes from the first window's start to the last one's end. All windows that a block can
have share most of their bytes; a region's group is the hash of these. Equal windows have equal anchors,
blocks and shared bytes, so windows need only be compared within a group, and each shard holds whole
groups.

1. Regions are rows of two hashes (anchors, content). Groups with one region are done. Equal regions
   are counted, not compared: all their windows occur again, and one of them stands for all.
2. Regions of a group that differ are fetched and laid side by side in a shard. Its suffix array is
   induced and the permuted common prefixes tell which windows occur at another place.
3. A group with too many different regions for one shard is split into smaller blocks, whose windows
   share more bytes, again and again where groups stay large, down to single windows, which differ no
   longer. No group is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import whole_text
from tickloom.llm.suffix_sort import permuted_prefixes, suffix_array
from tickloom.session import materialise

#: Not a byte of UTF-8: parts the regions of a shard.
_PART = b"\xff"


@dataclass(frozen=True)
class Settings:
    #: Bytes of a string whose repetition is removed.
    span: int = 400
    gram: int = 32
    #: Bytes of a shard, and different regions of a group from which on it is split.
    shard_bytes: int = 1_000_000
    group_regions: int = 2_500
    #: Windows of a block, at first and at each split.
    blocks: tuple[int, ...] = (128, 32, 8, 1)
    #: Windows looked at together in a very long text; at most 2^27.
    part_bytes: int = 1 << 24


_REGION = "doc_id bigint, text_hash bigint, start bigint, stop bigint, offset int, key bigint, content bigint"
_BYTES = _REGION + ", data binary"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """64-bit hashes of all grams, by doubling."""
    steps = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    h, size = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), 1
    for k in range(gram.bit_length() - 1):
        h = h[:-size] * np.uint64(steps[k % 4]) + h[size:]
        h ^= h >> np.uint64(31)
        size *= 2
    return h * np.uint64(steps[0])


def regions(data: bytes, s: Settings) -> Iterator[tuple[int, int, int, int, int]]:
    """start, stop (last window's start), offset (of the anchor), key, content of each region.

    Texts above ``part_bytes`` are taken in parts that overlap by all but one byte of a window.
    """
    view = memoryview(data)
    width = s.span - s.gram + 1
    size = s.blocks[0]
    for base in range(0, len(data) - s.span + 1, s.part_bytes):
        part = view[base : base + s.part_bytes + s.span - 1]
        h = gram_hashes(part, s.gram)
        # the hash above, the place below: ties go to the left
        packed = (h >> np.uint64(28) << np.uint64(28)) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(h) // width)
        tiled = np.full(rows * width, np.uint64(2**64 - 1))
        tiled[: len(h)] = packed
        tiled = tiled.reshape(rows, width)
        front = np.minimum.accumulate(tiled, axis=1).ravel()
        back = np.minimum.accumulate(tiled[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(len(part) - s.span + 1)
        least = np.minimum(back[starts], front[starts + width - 1])
        anchor = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
        block = (anchor - starts) // size
        moved = (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(np.append(True, moved))
        last = np.append(first[1:], len(anchor)) - 1
        for a, b, at, k in zip(
            first.tolist(), last.tolist(), anchor[first].tolist(), block[first].tolist(),
            strict=True,
        ):
            core = part[at - k * size : at - k * size - size + 1 + s.span]
            key = xxhash.xxh3_64_intdigest(core, k)
            content = xxhash.xxh3_64_intdigest(part[a : b + s.span], at - a)
            yield base + a, base + b, at - a, _signed(key), _signed(content)


def _all_regions(docs: DataFrame, s: Settings) -> DataFrame:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [
                (doc_id, text_hash, *region)
                for doc_id, text_hash, text in frame.itertuples(index=False)
                for region in regions(text.encode("utf-8", "replace"), s)
            ]
            yield _frame(out, 7)

    return docs.select("doc_id", "text_hash", "text").mapInPandas(run, _REGION)


def _frame(rows: list[tuple], width: int) -> pd.DataFrame:
    names = [x.split()[0] for x in _BYTES.split(", ")][:width]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def _with_bytes(chosen: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Chosen regions with their bytes, fetched once for each document."""
    by_doc = chosen.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "stop", "offset", "key", "content")).alias("regions")
    )
    by_doc = by_doc.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    # rows repeated under one id would fetch the same bytes again
    texts = docs.join(by_doc, on).dropDuplicates(["doc_id", "text_hash"])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, text_hash, text, found in frame.itertuples(index=False):
                data = text.encode("utf-8", "replace")
                out = [
                    (doc_id, text_hash, r["start"], r["stop"], r["offset"], r["key"], r["content"],
                     data[r["start"] : r["stop"] + s.span])
                    for r in found
                ]
                yield _frame(out, 8)

    return texts.select("doc_id", "text_hash", "text", "regions").mapInPandas(run, _BYTES)


def _blocks(rows: DataFrame, size: int, s: Settings) -> DataFrame:
    """Regions cut into blocks of ``size`` windows, counted from the anchor."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text_hash, start, stop, offset, key, _, data in frame.itertuples(
                index=False
            ):
                # windows by their distance before the anchor: offset, offset - 1, ...
                far, near = offset, offset - (stop - start)
                for block in range(near // size, far // size + 1):
                    high, low = min(far, block * size + size - 1), max(near, block * size)
                    a, b = offset - high, offset - low
                    core = data[offset - block * size : offset - block * size - size + 1 + s.span]
                    new_key = xxhash.xxh3_64_intdigest(core, (key ^ block) & (2**64 - 1))
                    content = xxhash.xxh3_64_intdigest(data[a : b + s.span], high)
                    out.append(
                        (doc_id, text_hash, start + a, start + b, high, _signed(new_key),
                         _signed(content), data[a : b + s.span])
                    )
            yield _frame(out, 8)

    ordered = [x.split()[0] for x in _BYTES.split(", ")]
    return rows.select(*ordered).mapInPandas(run, _BYTES)


def repeated_windows(items: list[bytes], span: int) -> list[list[tuple[int, int]]]:
    """For each item, the runs of window starts whose window is found at another place too."""
    data = _PART.join(items) + _PART
    before, length = permuted_prefixes(data, suffix_array(np.frombuffer(data, np.uint8)))
    again = length >= span
    twice = np.zeros(len(data) + 1, np.int8)
    twice[:-1][again] = 1
    twice[before[again]] = 1
    out, at = [], 0
    for item in items:
        # starts nearer to the end would run into the next region
        whole = max(len(item) - span + 1, 0)
        marks = np.diff(twice[at : at + whole], prepend=0, append=0)
        out.append(
            list(
                zip(
                    np.flatnonzero(marks == 1).tolist(),
                    (np.flatnonzero(marks == -1) - 1).tolist(),
                    strict=True,
                )
            )
        )
        at += len(item) + 1
    return out


def _compare(rows: DataFrame, s: Settings) -> DataFrame:
    """Windows that occur twice within a group; the rows of a partition are sorted by group."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size, last = 0, None

        def shard() -> pd.DataFrame:
            found = repeated_windows([r[3] for r in held], s.span)
            out = [
                (doc_id, text_hash, start + a, start + b)
                for (doc_id, text_hash, start, _), runs in zip(held, found, strict=True)
                for a, b in runs
            ]
            return _frame(out, 4)

        for frame in frames:
            for doc_id, text_hash, start, key, data in frame.itertuples(index=False):
                if size >= s.shard_bytes and key != last:
                    yield shard()
                    held, size = [], 0
                held.append((doc_id, text_hash, start, data))
                size, last = size + len(data), key
        if held:
            yield shard()

    dealt = rows.select("doc_id", "text_hash", "start", "key", "data").repartition("key")
    return dealt.sortWithinPartitions("key").mapInPandas(
        run, "doc_id bigint, text_hash bigint, start bigint, stop bigint"
    )


def repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, text_hash, start, stop: runs of windows (by their starts) that occur elsewhere."""
    keyed = _keyed(docs)
    rows = materialise(_all_regions(keyed, s), "regions")
    found = None
    for level, block in enumerate(s.blocks):
        if level:
            rows = materialise(_blocks(hot, block, s), "region_blocks")
        first = F.min(F.struct("start", "doc_id", "text_hash", "stop", "offset")).alias("first")
        counts = materialise(
            rows.groupBy("key", "content").agg(F.count("*").alias("n"), first), "region_counts"
        )
        groups = counts.groupBy("key").agg(F.count("*").alias("d")).filter("d > 1")
        again = rows.join(counts.filter("n > 1").select("key", "content"), ["key", "content"])
        part = again.select("doc_id", "text_hash", "start", "stop")
        found = part if found is None else found.unionByName(part)
        # the first of equal regions stands for them
        one = counts.join(groups, "key").select("first.*", "key", "content", "d")
        if level:
            names = ("doc_id", "text_hash", "start", "key", "content")
            one = one.select(*[F.col(c).alias(f"_{c}") for c in names], "d")
            same = [F.col(c) == F.col(f"_{c}") for c in names[1:]]
            on = reduce(and_, same, F.col("doc_id").eqNullSafe(F.col("_doc_id")))
            chosen = rows.join(one, on).select(*rows.columns, "d")
        else:
            chosen = _with_bytes(one.drop("d"), keyed, s).join(groups, "key")
        chosen = materialise(chosen, "region_bytes")
        found = found.unionByName(
            _compare(chosen.filter(F.col("d") <= s.group_regions), s).select(*part.columns)
        )
        hot = chosen.filter(F.col("d") > s.group_regions).drop("d")
        if hot.isEmpty():
            break
    return found


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))


def covered(starts: list[tuple[int, int]], span: int) -> list[tuple[int, int]]:
    """Maximal byte runs under windows given by runs of their starts; ends are exclusive."""
    out: list[list[int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + span)
        else:
            out.append([a, b + span])
    return [(a, b) for a, b in out]


def _with_runs(docs: DataFrame, s: Settings) -> DataFrame:
    keyed = _keyed(docs)
    runs = (
        repeats(docs, s).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("runs"))
    )
    runs = materialise(runs, "repeat_runs")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return keyed.join(runs, on, "left").select("doc_id", "text", "runs")


def remove_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each document without the bytes covered by a ``span``-byte string that also starts elsewhere.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes
    left), spans (start and end of each run), kept (the bytes left). Matches lie within documents,
    and strings are judged on the input. One row per row of ``docs``: a null text is empty, texts
    shorter than ``span`` are kept; repeated rows, also those with null ids, are repeats of each
    other and lose everything repeated; an empty table gives no rows; other columns are ignored.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, runs in frame.itertuples(index=False):
                data = text.encode("utf-8", "replace")
                starts = [] if runs is None else [(r["start"], r["stop"]) for r in runs]
                spans = covered(starts, settings.span)
                edges = [0, *(x for pair in spans for x in pair), len(data)]
                kept = b"".join(
                    data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)
                )
                out.append(
                    (doc_id, len(data), len(data) - len(kept), len(spans),
                     hashlib.sha256(kept).hexdigest(), [list(x) for x in spans], kept)
                )
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return _with_runs(docs, settings).mapInPandas(
        run,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<array<bigint>>, kept binary",
    )
