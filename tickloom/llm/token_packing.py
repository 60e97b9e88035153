"""Token ids packed into rows of fixed width by best-fit-decreasing, and written as matrices.

A document's ids (its end token included) longer than a row are split without loss: whole rows, then
the rest. The rests of a shard are placed longest first, each into the open row with the least room
that still takes it. Rows are kept by their room, and a segment tree over the possible rooms finds
the least one that is large enough in ``log2(width)`` steps.

A shard is a bounded number of tokens of one task, so memory is bounded, nothing is shuffled to
pack, and no source or document is gathered anywhere. Shards are cut by stored order alone: a task
that is run again packs the same rows.

The packed rows are written once, as blocks of binary matrices: ids padded to the width, positions
that begin anew at every segment, the cumulative lengths of the segments (from 0; the last one is
where the padding starts), and for each segment its document and place in it. A block knows its task
and its first row there; counts per task give dense numbers when the blocks are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import whole_text
from tickloom.llm.tokens import Encoder
from tickloom.session import fresh_path

#: Blocks of rows: all numbers little-endian, of 32 bits but for ``doc_ids`` and ``starts`` (64).
#: ``ids`` and ``positions`` are row-major, ``n_rows`` by ``width``. ``segments`` counts each row's
#: segments; ``cu_seqlens`` joins their cumulative lengths, each row's from 0; ``known`` has a byte
#: for each segment, 0 where the document has no id.
MATRIX = (
    "task bigint, first_row bigint, n_rows int, width int, ids binary, positions binary, "
    "segments binary, cu_seqlens binary, doc_ids binary, known binary, starts binary"
)
ROWS = (
    "sequence_id bigint, ids array<int>, cu_seqlens array<int>, positions array<int>, "
    "doc_ids array<bigint>, starts array<bigint>"
)


_ROW_GROUP = 16 << 20


class Rooms:
    """Open rows by the room left, with a segment tree over which rooms are taken."""

    def __init__(self, width: int):
        self._leaves = 1 << width.bit_length()
        self._filled = [0] * (2 * self._leaves)
        self._rows: dict[int, list[int]] = {}

    def add(self, row: int, room: int) -> None:
        self._rows.setdefault(room, []).append(row)
        self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``length``, and that room; it is removed."""
        room = self._least(length)
        if room is None:
            return None
        self._count(room, -1)
        return self._rows[room].pop(), room

    def _count(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._filled[node] += by
            node >>= 1

    def _least(self, length: int) -> int | None:
        node = length + self._leaves
        if not self._filled[node]:
            # up to the first ancestor with something to the right, then down its left edge
            while node > 1 and (node & 1 or not self._filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._filled[2 * node] else 2 * node + 1
        return node - self._leaves


def best_fit(lengths: Sequence[int], width: int) -> list[list[int]]:
    """Places of ``lengths`` (each at most ``width``) by row; equal lengths in the given order."""
    rooms, rows = Rooms(width), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            found = len(rows), width
            rows.append([])
        row, room = found
        rows[row].append(i)
        if room > lengths[i]:
            rooms.add(row, room - lengths[i])
    return rows


class Block:
    """Rows of a matrix being filled."""

    def __init__(self, width: int, rows: int, pad_id: int):
        self._width, self._rows, self._pad = width, rows, pad_id
        self._counting = np.arange(width, dtype="<i4")
        self._begin()

    def _begin(self) -> None:
        self._ids = np.full((self._rows, self._width), self._pad, "<i4")
        self._positions = np.zeros((self._rows, self._width), "<i4")
        self.n, self._segments, self._ends = 0, [], []
        self._docs: list[int] = []
        self._known = bytearray()
        self._starts: list[int] = []

    @property
    def full(self) -> bool:
        return self.n == self._rows

    def add(self, group: Iterable[tuple[int | None, int, np.ndarray]]) -> None:
        """One row of (document, ids before, ids)."""
        end, count = 0, 0
        self._ends.append(0)
        for doc, start, ids in group:
            stop = end + len(ids)
            self._ids[self.n, end:stop] = ids
            self._positions[self.n, end:stop] = self._counting[: len(ids)]
            end, count = stop, count + 1
            self._ends.append(end)
            self._docs.append(0 if doc is None else doc)
            self._known.append(doc is not None)
            self._starts.append(start)
        self._segments.append(count)
        self.n += 1

    def take(self, task: int, first_row: int) -> pa.RecordBatch:
        """The rows as one stored block; begins anew."""
        columns = {
            "task": (task, pa.int64()), "first_row": (first_row, pa.int64()),
            "n_rows": (self.n, pa.int32()), "width": (self._width, pa.int32()),
            "ids": (self._ids[: self.n].tobytes(), pa.binary()),
            "positions": (self._positions[: self.n].tobytes(), pa.binary()),
            "segments": (np.array(self._segments, "<i4").tobytes(), pa.binary()),
            "cu_seqlens": (np.array(self._ends, "<i4").tobytes(), pa.binary()),
            "doc_ids": (np.array(self._docs, "<i8").tobytes(), pa.binary()),
            "known": (bytes(self._known), pa.binary()),
            "starts": (np.array(self._starts, "<i8").tobytes(), pa.binary()),
        }
        self._begin()
        return pa.record_batch([pa.array([v], t) for v, t in columns.values()], names=list(columns))


def matrices(
    docs: DataFrame,
    width: int = 2048,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 50256,
    pad_id: int = 50256,
    shard_tokens: int = 1 << 22,
    rows: int = 16,
) -> DataFrame:
    """Packed rows of all documents, in blocks of at most ``rows``; see ``MATRIX``."""
    if width < 1 or shard_tokens < 1 or rows < 1:
        raise ValueError("width, shard_tokens and rows must be positive")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, done, task = Encoder(tokenizer), Block(width, rows, pad_id), 0, 0
        held: list[tuple[int | None, int, np.ndarray]] = []
        size = 0

        def shard() -> Iterator[list[tuple[int | None, int, np.ndarray]]]:
            for places in best_fit([len(x) for _, _, x in held], width):
                yield [held[i] for i in places]

        def placed(groups: Iterable) -> Iterator[pa.RecordBatch]:
            nonlocal done
            for group in groups:
                block.add(group)
                if block.full:
                    done += rows
                    yield block.take(task, done - rows)

        for batch in batches:
            for doc, text, at in zip(*(batch.column(i) for i in range(3)), strict=True):
                task, doc = at.as_py(), doc.as_py()
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end_id)).astype(np.int32)
                whole = len(ids) // width * width
                yield from placed([(doc, a, ids[a : a + width])] for a in range(0, whole, width))
                if whole < len(ids):
                    held.append((doc, whole, ids[whole:].copy() if whole else ids))
                    size += len(ids) - whole
                if size >= shard_tokens:
                    yield from placed(shard())
                    held.clear()
                    size = 0
        yield from placed(shard())
        if block.n:
            yield block.take(task, done)

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text().alias("text"),
        F.spark_partition_id().cast("long").alias("task"),
    )
    return narrow.mapInArrow(run, MATRIX)


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """Pack ``docs`` (options as of ``matrices``) and write the blocks.

    A reader holds a row group at a time, so these are kept small beside an executor's memory.
    """
    writer = matrices(docs, **options).write.mode("errorifexists")
    writer.option("parquet.block.size", str(_ROW_GROUP)).parquet(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """The packed rows back from the stored blocks: ``ROWS``, with dense ``sequence_id``."""
    stored = spark.read.schema(MATRIX).parquet(path)
    counts = stored.groupBy("task").agg(F.sum("n_rows").alias("n"))
    # two numbers for each task of the scan that packed: under 32 MB for a million tasks
    bases = counts.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("base"))
    numbered = stored.join(F.broadcast(bases), "task").select(
        (F.col("base") + F.col("first_row")).alias("first"), "n_rows", "width", "ids", "positions",
        "segments", "cu_seqlens", "doc_ids", "known", "starts",
    )

    def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                n, width = row["n_rows"], row["width"]
                ids, positions = (np.frombuffer(row[c], "<i4") for c in ("ids", "positions"))
                segments, ends = (np.frombuffer(row[c], "<i4") for c in ("segments", "cu_seqlens"))
                of_segment = np.concatenate(([0], np.cumsum(segments)))
                of_end = of_segment + np.arange(n + 1)
                # positions end where the last segment does
                used = ends[of_end[1:] - 1]
                inside = np.arange(width) < used[:, None]
                absent = np.frombuffer(row["known"], np.uint8) == 0
                columns = [
                    pa.array(np.arange(row["first"], row["first"] + n)),
                    lists(np.arange(n + 1) * width, pa.array(ids)),
                    lists(of_end, pa.array(ends)),
                    lists(np.concatenate(([0], np.cumsum(used))), pa.array(positions.reshape(n, width)[inside])),
                    lists(of_segment, pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=absent)),
                    lists(of_segment, pa.array(np.frombuffer(row["starts"], "<i8"))),
                ]
                yield pa.record_batch(columns, names=[c.split(" ")[0] for c in ROWS.split(", ")])

    return numbered.mapInArrow(run, ROWS)


def pack_tokens(docs: DataFrame, **options) -> DataFrame:
    """Packed rows of all documents: sequence_id, ids, cu_seqlens, positions, doc_ids, starts.

    They are written as matrices in the shared folder and read from there. ``doc_ids`` and ``starts``
    name, for each segment, its document and how many of that document's ids came before. Each row
    of ``docs`` is a document of its own, repeated and null ids included; a null or empty text is its
    end token alone; equal lengths are placed in stored order. An empty table gives no rows; columns
    other than doc_id and text are ignored. ``options`` are those of ``matrices``.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "matrices")
    write_matrices(docs, path, **options)
    return read_matrices(spark, path)
