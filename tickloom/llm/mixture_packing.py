"""Mixture-controlled packing of tokenised documents by deficit round-robin over source queues.

Documents are cut into pieces whose lengths are powers of two (as many ``unit`` pieces as fit, then
the binary digits of the rest), so pieces of one source join without a gap into blocks of ``unit``
tokens. Each source is a queue of blocks. In every round (one window of ``window`` tokens) a source
earns its quantum, ``window`` times its target share, and sends a block for each ``unit`` it has
earned; what it has not spent is its deficit and stays for the next round. After r rounds a source
has sent ``floor(r * quantum / unit)`` blocks, whatever the others did, so block j leaves in round
``ceil((j + 1) * unit / quantum)``. The deficit is thereby carried across windows and partitions
without any running state: each block knows its round, blocks are put in the order of (round,
source), and every ``window / unit`` of them fill a window.

Blocks a queue could not complete (fewer than ``unit`` tokens for each source and piece length) are
packed at the end, longest first, which also leaves no gap. Only the very last window can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom.llm.common import numbered_parts
from tickloom.llm.tokens import Encoder
from tickloom.session import materialise

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("task", T.LongType()),
        T.StructField("rank", T.LongType()),
    ]
)


def lengths(tokens: int, unit: int) -> list[int]:
    """Piece lengths of a document: whole units, then the binary digits of the rest."""
    rest = tokens % unit
    digits = [1 << k for k in range(unit.bit_length() - 2, -1, -1) if rest >> k & 1]
    return [unit] * (tokens // unit) + digits


def cut(docs: DataFrame, unit: int, tokenizer: str, end_id: int) -> DataFrame:
    """Pieces of all documents; ``rank`` counts them within (task, source, length)."""

    def pieces(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        ranks: dict[tuple[str, int], int] = {}
        for frame in frames:
            out = []
            for doc_id, text, source, task in frame.itertuples(index=False):
                ids = encoder.ids(text).astype("<u4")
                data = ids.tobytes() + end_id.to_bytes(4, "little")
                total, start = len(data) // 4, 0
                for length in lengths(total, unit):
                    rank = ranks.get((source, length), 0)
                    ranks[source, length] = rank + 1
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    out.append((doc_id, source, start, length, crc, total, task, rank))
                    start += length
            yield pd.DataFrame(out, columns=PIECES.fieldNames()).astype({"doc_id": "Int64"})

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.spark_partition_id().cast("long").alias("task"),
    )
    return narrow.mapInPandas(pieces, PIECES)


def mixture_pack(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    window: int = 1024,
    unit: int = 256,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 0,
) -> DataFrame:
    """Pack every token of every document; one row per piece.

    ``weights`` are the target token shares by source (null source: empty string); a source without
    one, and all if it is None, has its share of the corpus. ``window`` and ``unit`` are powers of
    two. Each row of ``docs`` is a document of its own, repeated or null ids included; a null or
    empty text is its end token alone. Equal ranks are settled by source, then by stored order. No
    rows give no rows; columns other than doc_id, text and source are ignored.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.
    """
    if window & (window - 1) or unit & (unit - 1) or not 0 < unit <= window:
        raise ValueError("window and unit must be powers of two, unit at most window")
    pieces = materialise(cut(docs, unit, tokenizer, end_id), "pieces")

    # ranks over the whole queue: a piece's place in its task, after all earlier tasks
    counts = pieces.groupBy("task", "source", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source", "length").orderBy("task")
    before = counts.select(
        "task", "source", "length",
        (F.sum("n").over(earlier) - F.col("n")).alias("before"),
    )
    queues = counts.groupBy("source", "length").agg(F.sum("n").alias("n"))
    per_block = F.lit(unit).cast("long")
    by_length = Window.partitionBy("source").orderBy(F.desc("length"))
    whole = F.floor(F.col("n") * F.col("length") / per_block)
    queues = queues.select(
        "source", "length", whole.alias("blocks"),
        (F.sum(whole).over(by_length) - whole).alias("first_block"),
        F.sum(whole).over(Window.partitionBy("source")).alias("source_blocks"),
    )
    shares = queues.groupBy("source").agg(F.max("source_blocks").alias("source_blocks"))
    total = shares.agg(F.sum("source_blocks")).first()[0] or 0
    chosen = {k: v for k, v in (weights or {}).items() if v > 0}
    share = F.col("source_blocks") / F.lit(max(total, 1))
    if chosen:
        given = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
        share = F.coalesce(F.element_at(given, F.col("source")), share)

    rank = F.col("before") + F.col("rank")
    inside = rank * F.col("length")
    block = F.floor(inside / per_block)
    placed = (
        pieces.join(before.join(queues, ["source", "length"]), ["task", "source", "length"])
        .select(
            "doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "task", "rank",
            F.when(block < F.col("blocks"), F.col("first_block") + block).alias("block"),
            F.pmod(inside, per_block).alias("inside"),
            # a little is taken off so that an exact quotient stays in its own round
            F.ceil(
                F.try_divide((F.col("first_block") + block + 1) * per_block, F.lit(window) * share)
                - 1e-9
            ).alias("round"),
        )
    )
    placed = materialise(placed, "placed_pieces")

    blocks = placed.filter("block IS NOT NULL AND inside = 0").select("source", "block", "round")
    order = [F.col("round"), F.col("source"), F.col("block")]
    lined = numbered_parts(blocks, order, "blocks")
    lined = _running(lined, F.lit(1)).select("source", "block", "at")
    slots = window // unit
    packed = placed.filter("block IS NOT NULL").join(lined, ["source", "block"])
    packed = packed.select(
        *_ROW,
        F.floor(F.col("at") / slots).alias("sequence_id"),
        (F.pmod(F.col("at"), F.lit(slots)) * unit + F.col("inside")).alias("offset"),
        "source",
    )

    order = [F.desc("length"), F.col("source"), F.col("task"), F.col("rank")]
    rest = numbered_parts(placed.filter("block IS NULL"), order, "rest_pieces")
    # the last window of blocks may be short: the rest goes on right after it
    at = F.col("at") + F.lit(total * unit)
    rest = _running(rest, F.col("length")).select(
        *_ROW,
        F.floor(at / window).alias("sequence_id"),
        F.pmod(at, F.lit(window)).cast("long").alias("offset"),
        "source",
    )
    return packed.unionByName(rest)


_ROW = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


def _running(lined: DataFrame, weight) -> DataFrame:
    """``at``: the sum of ``weight`` over all rows that stand before a row of a numbered table."""
    sized = lined.withColumn("weight", weight.cast("long"))
    parts = sized.groupBy("part").agg(F.sum("weight").alias("sum"))
    over = Window.orderBy("part")
    parts = parts.select("part", (F.sum("sum").over(over) - F.col("sum")).alias("base"))
    inside = F.sum("weight").over(Window.partitionBy("part").orderBy("row")) - F.col("weight")
    return (
        sized.withColumn("inside_part", inside)
        .join(parts, "part")
        .withColumn("at", F.col("base") + F.col("inside_part"))
        .drop("base", "inside_part", "weight")
    )
