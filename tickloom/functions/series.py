"""Ordered-series primitives that never put a whole symbol into one task.

A long history is cut into *chunks* of ``CHUNK_BARS`` consecutive bars. Three pieces are enough
for every ordered operator of this package:

``number_bars``  global bar position per key, from per-slot counts plus a local row number;
``spread``       copies of the last few bars of a chunk into the chunks that look back at them,
                 so bounded frames are computed inside one chunk and stay exact;
``carried``      exclusive scan over one summary row per chunk, for state of unbounded memory.

Only chunk summaries (one row per 4,096 bars) are ever ordered per symbol.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK_BARS = 4096
DAY_SECONDS = 86_400


def spacing(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> float:
    """Seconds between bars on the densest day of any key (one number, counted map-side).

    Slots of ``chunk_bars`` times this length hold no more bars than a chunk, as far as bars are
    evenly spread over a day. Keys may mix bar sizes, with the granularity as one of them.
    """
    day = F.floor(F.unix_seconds(F.col(ts)) / DAY_SECONDS)
    counted = df.groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    return DAY_SECONDS / max(counted.agg(F.max("_rows")).first()[0] or 1, 1)


def slot_of(ts: str, bar_seconds: float = DAY_SECONDS, chunk_bars: int = CHUNK_BARS) -> Column:
    """Fixed time slot of a bar; unique bar opens bound a slot to ``chunk_bars`` rows per key."""
    return F.floor(F.unix_seconds(F.col(ts)) / F.lit(bar_seconds * chunk_bars)).cast("long")


def number_bars(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    *,
    bar_seconds: float | None = DAY_SECONDS,
    chunk_bars: int = CHUNK_BARS,
    firsts: Mapping[str, str] | None = None,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``rn`` (0-based position by ``ts``) and ``n`` (bars of the key).

    ``bar_seconds`` is the least distance of two bars of a key; None takes it from the data, for
    bars of any size (see ``spacing``).
    ``firsts`` maps new column -> column whose value at the key's first bar is wanted;
    ``totals`` maps new column -> per-row numeric expression summed over the key.
    The counting branch reads key columns only and combines map-side.
    """
    keys, firsts, totals = list(keys), dict(firsts or {}), dict(totals or {})
    if bar_seconds is None:
        bar_seconds = spacing(df, keys, ts)
    slotted = df.withColumn("_slot", slot_of(ts, bar_seconds, chunk_bars))
    tallies = slotted.groupBy(*keys, "_slot").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.min_by(column, ts).alias(f"_f_{name}") for name, column in firsts.items()],
        *[F.sum(expr).alias(f"_t_{name}") for name, expr in totals.items()],
    )
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy("_slot")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select(
        *keys,
        "_slot",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("n"),
        *[F.first(f"_f_{name}").over(ordered).alias(name) for name in firsts],
        *[F.sum(f"_t_{name}").over(whole).alias(name) for name in totals],
    )
    inside = Window.partitionBy(*keys, "_slot").orderBy(ts)
    return (
        slotted.withColumn("_local", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_slot"])
        .withColumn("rn", F.col("_offset") + F.col("_local"))
        .drop("_slot", "_local", "_offset")
    )


def spread(df: DataFrame, lookback: int, *, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Add ``chunk`` and ``core``; bars within ``lookback`` of a later chunk are copied into it."""
    home = F.floor(F.col("rn") / F.lit(chunk_bars)).cast("long")
    reach = F.least(
        F.floor((F.col("rn") + F.lit(lookback)) / F.lit(chunk_bars)).cast("long"),
        F.floor((F.col("n") - 1) / F.lit(chunk_bars)).cast("long"),
    )
    return df.withColumn("chunk", F.explode(F.sequence(home, reach))).withColumn(
        "core", F.col("chunk") == home
    )


def by_chunk(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Hash rows to their chunk, keeping the configured number of shuffle partitions.

    Adaptive coalescing sizes partitions by the bytes that arrive; where each row is about to be
    expanded many times, that would leave too few tasks.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys, "chunk")


def chunk_order(keys: Sequence[str] = ("symbol",)) -> WindowSpec:
    """Bars of one chunk in order; the only per-bar ordering this package asks Spark for."""
    return Window.partitionBy(*keys, "chunk").orderBy("rn")


def trailing(w: WindowSpec, size: int) -> WindowSpec:
    return w.rowsBetween(-(size - 1), 0)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def carried(keys: Sequence[str]) -> WindowSpec:
    """Frame over chunk summaries strictly before the current chunk."""
    return (
        Window.partitionBy(*keys)
        .orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def full_mean(column: Column | str, w: WindowSpec, size: int) -> Column:
    """Moving average, NULL until ``size`` non-null values are in the frame."""
    frame = trailing(w, size)
    return F.when(F.count(column).over(frame) == size, F.avg(column).over(frame))


def full_max(column: Column | str, w: WindowSpec, size: int) -> Column:
    frame = trailing(w, size)
    return F.when(F.count(column).over(frame) == size, F.max(column).over(frame))


def full_min(column: Column | str, w: WindowSpec, size: int) -> Column:
    frame = trailing(w, size)
    return F.when(F.count(column).over(frame) == size, F.min(column).over(frame))


# --- long frames --------------------------------------------------------------------------
#
# A sliding frame is evaluated row by row, so a 200-bar mean costs 200 updates per bar. A long
# frame is therefore put together from short ones: the aggregate of the last ``d`` bars, taken
# ``size / d`` times at distances of ``d`` bars. For 200 bars that is 20 + 10 steps.


def tile_size(size: int) -> int:
    """Divisor of ``size`` that makes the frame plus the number of tiles smallest."""
    divisors = [d for d in range(1, size + 1) if size % d == 0]
    return min(divisors, key=lambda d: (d + size // d, d))


def tiles(name: str, column: str, w: WindowSpec, size: int, *kinds: str) -> dict[str, Column]:
    """Short-frame columns (the count and each of ``kinds``) that ``tiled`` puts together."""
    frame = trailing(w, tile_size(size))
    return {
        f"_{name}_{kind}": getattr(F, kind)(column).over(frame) for kind in ("count", *kinds)
    }


def tiled(name: str, w: WindowSpec, size: int, kind: str) -> Column:
    """``kind`` (count, sum, max or min) over the last ``size`` bars, from columns of ``tiles``."""
    step = tile_size(size)
    column = f"_{name}_{kind}"
    parts = [F.lag(column, j * step).over(w) if j else F.col(column) for j in range(size // step)]
    if kind in ("count", "sum"):
        return reduce(lambda a, b: a + b, [F.coalesce(part, F.lit(0)) for part in parts])
    if len(parts) == 1:
        return parts[0]
    return F.greatest(*parts) if kind == "max" else F.least(*parts)


def when_full(name: str, w: WindowSpec, size: int, value: Column) -> Column:
    """``value`` once the frame holds ``size`` non-null values."""
    return F.when(tiled(name, w, size, "count") == size, value)


def running_peak(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Add ``peak``: maximum of ``value`` up to and including each bar (needs ``rn``, ``chunk``)."""
    keys = list(keys)
    local = df.withColumn("_peak", F.max(value).over(so_far(chunk_order(keys))))
    tops = df.groupBy(*keys, "chunk").agg(F.max(value).alias("_top"))
    carry = tops.select(*keys, "chunk", F.max("_top").over(carried(keys)).alias("_before"))
    return (
        local.join(carry, [*keys, "chunk"])
        .withColumn("peak", F.greatest("_peak", "_before"))
        .drop("_peak", "_before")
    )


def largest_step(df: DataFrame, day: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Largest distance in days between consecutive rows of a key; NULL for a single row.

    Distances inside a time slot come from ``lag``; distances between slots come from the slots'
    first and last days, so no key is ordered as a whole.
    """
    keys = list(keys)
    slotted = df.withColumn("_slot", slot_of(ts))
    w = Window.partitionBy(*keys, "_slot").orderBy(ts)
    per_slot = (
        slotted.withColumn("_step", F.datediff(F.col(day), F.lag(day).over(w)))
        .groupBy(*keys, "_slot")
        .agg(F.max("_step").alias("_step"), F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    )
    jump = F.datediff("_lo", F.lag("_hi").over(Window.partitionBy(*keys).orderBy("_slot")))
    return (
        per_slot.withColumn("_jump", jump)
        .groupBy(*keys)
        .agg(F.max(F.greatest("_step", "_jump")).alias("largest_step"))
    )


def evenly_spaced(rn: Column, n: Column, limit: int) -> Column:
    """True for the rows an even-stride thinning to ``limit`` points keeps (both ends included).

    Row ``i`` is kept when some ``j`` in ``0..limit-1`` has ``rint(j * step) == i``. Because the
    stride is at least one, only the two neighbours of ``i / step`` can match, so the test is
    row-local and needs no index join.
    """
    if limit < 2:
        raise ValueError("limit must be at least 2")
    step = (n - 1).cast("double") / F.lit(float(limit - 1))
    guess = rn.cast("double") / F.nullif(step, F.lit(0.0))
    hit = [
        (F.rint(j * step) == rn.cast("double")) & (j <= F.lit(float(limit - 1)))
        for j in (F.floor(guess).cast("double"), F.ceil(guess).cast("double"))
    ]
    return (n <= limit) | F.coalesce(hit[0] | hit[1], F.lit(False)) | (rn == n - 1)
