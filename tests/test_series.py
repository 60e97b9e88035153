import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.walk import bars, frame, wave
from tickloom.functions import ranking, series
from tickloom.functions.ranking import exact_median, keep_recent
from tickloom.functions.series import (
    chunk_order,
    evenly_spaced,
    full_mean,
    largest_step,
    number_bars,
    running_peak,
    spread,
    tile_size,
    tiled,
    tiles,
    trailing,
)
from tickloom.operators.indicators import indicators


def test_numbers_run_through_slots(spark):
    df = frame(spark, bars(wave(50), "A", step=3), bars(wave(7), "B"))
    rows = number_bars(df, chunk_bars=4, firsts={"c0": "close"}).orderBy("symbol", "ts").collect()
    assert [r.rn for r in rows] == [*range(50), *range(7)]
    assert {(r.symbol, r.n) for r in rows} == {("A", 50), ("B", 7)}
    assert all(r.c0 == wave(1)[0] for r in rows)


@pytest.mark.parametrize("chunk", [3, 8, 4096])
def test_moving_average_does_not_depend_on_chunks(spark, chunk):
    values = wave(60)
    df = spread(number_bars(frame(spark, bars(values)), chunk_bars=chunk), 9, chunk_bars=chunk)
    rows = (
        df.withColumn("m", full_mean("close", chunk_order(), 10)).where("core").orderBy("rn")
        .collect()
    )
    assert len(rows) == 60
    for i, row in enumerate(rows):
        if i < 9:
            assert row.m is None
        else:
            assert row.m == pytest.approx(sum(values[i - 9:i + 1]) / 10, abs=1e-10)


@pytest.mark.parametrize("size", [1, 7, 12, 50])
def test_tiled_frames_equal_plain_frames(spark, size):
    df = spread(number_bars(frame(spark, bars(wave(90)))), size)
    w = chunk_order()
    staged = df.withColumns(tiles("x", "close", w, size, "sum", "max", "min"))
    rows = staged.select(
        "rn",
        *[tiled("x", w, size, k).alias(k) for k in ("count", "sum", "max", "min")],
        *[getattr(F, k)("close").over(trailing(w, size)).alias(f"plain_{k}")
          for k in ("count", "sum", "max", "min")],
    ).collect()
    for r in rows:
        assert r["count"] == r.plain_count and r["sum"] == pytest.approx(r.plain_sum, rel=1e-13)
        assert (r["max"], r["min"]) == (r.plain_max, r.plain_min)
    assert tile_size(200) == 10 or tile_size(200) == 20


def test_indicators_agree_for_any_chunk_size(spark):
    df = frame(spark, bars(wave(260), "A", step=2), bars(wave(230, shift=4), "B"))
    small, large = (
        indicators(df, **size).selectExpr(
            "symbol", "ts", "round(sma_50, 8) a", "round(sma_200, 8) b", "round(rsi_14, 8) c",
            "round(bb_upper_20, 8) d", "vol_sma_20", "daily_return")
        for size in ({"chunk_bars": 32}, {})
    )
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert large.where("b is not null").count() == 61 + 31


def test_running_peak_and_largest_step(spark):
    values = [5, 7, 6, 9, 8, 4, 10, 3]
    df = spread(number_bars(frame(spark, bars(values)), chunk_bars=3), 0, chunk_bars=3)
    got = running_peak(df.select("symbol", "rn", "chunk", "close"), "close", ("symbol",))
    assert [r.peak for r in got.orderBy("rn").collect()] == [5, 7, 7, 9, 9, 9, 10, 10]
    days = [dt.date(1990, 1, 1), dt.date(1990, 1, 4), dt.date(2010, 1, 1), dt.date(2010, 1, 2)]
    dated = spark.createDataFrame([("A", d) for d in days] + [("B", days[0])],
                                  "symbol string, day date").withColumn("ts", F.to_timestamp("day"))
    steps = {r.symbol: r.largest_step for r in largest_step(dated, "day", ("symbol",)).collect()}
    assert steps == {"A": (days[2] - days[1]).days, "B": None}


@pytest.mark.parametrize("n,limit", [(1000, 400), (401, 400), (400, 400), (7, 3), (2405, 400)])
def test_thinning_keeps_the_even_stride_set(spark, n, limit):
    step = (n - 1) / (limit - 1)
    want = set(range(n)) if n <= limit else {round(i * step) for i in range(limit)} | {n - 1}
    rows = spark.range(n).where(evenly_spaced(F.col("id"), F.lit(n), limit)).collect()
    assert {r.id for r in rows} == want


def test_exact_median(spark):
    groups = {"odd": [3.0, 1.0, 2.0], "even": [1.0, 9.0, -4.0, 2.5], "same": [0.5] * 9,
              "gap": [-5.0, 5.0], "one": [7.25]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("odd", None), ("none", None)]
    got = exact_median(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    assert {r.g: r.median for r in got} == {
        "odd": 2.0, "even": 1.75, "same": 0.5, "gap": 0.0, "one": 7.25}


def test_keep_recent_rejects_zero(spark):
    with pytest.raises(ValueError):
        keep_recent(spark.range(1), ["id"], 0, "id")


def test_exact_median_searched_in_rounds(spark):
    """Ties, NaN, infinities, signed zeros and NULL keys, with values far closer than any fixed cell."""
    rng = random.Random(4)
    rows = []
    for g, n in (("one cell", 3_000), ("ties", 2_000), ("nan", 801), (None, 500), ("tiny", 1), ("two", 2)):
        for _ in range(n):
            value = 1.0 + rng.random() * 1e-9
            if g == "ties":
                value = float(rng.choice([-0.0, 0.0, 1.0, 2.0, float("inf"), float("-inf"), rng.random()]))
            elif g == "nan" and rng.random() < 0.6:
                value = float("nan")
            rows.append((g, value))
    rows += [("nan edge", 1.0), ("nan edge", float("nan")), ("empty", None), ("third", 1.0), ("third", 2.0),
             ("third", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    want = {r.g: repr(r.m) for r in df.groupBy("g").agg(F.median("v").alias("m")).collect() if r.m is not None}
    assert want["third"] == "2.0" and want["nan edge"] == "nan"
    for limit, pivots in ((50_000, 64), (40, 5), (3, 2)):
        got = {r.g: repr(r.median) for r in exact_median(df, ["g"], "v", limit=limit, pivots=pivots).collect()}
        assert got == want


def test_exact_median_orders_only_small_cells(spark):
    """A group inside one former cell: no window partition gets more than the limit."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), (1 + F.col("id") * 1e-9).alias("v"))
    plan = exact_median(df, ["g"], "v", limit=100, pivots=16)
    assert plan.first().median == df.agg(F.median("v")).first()[0]
    searched = ranking._inside
    seen = []
    try:
        ranking._inside = lambda *a: seen.append(searched(*a).count()) or searched(*a)
        exact_median(df, ["g"], "v", limit=100, pivots=16)
    finally:
        ranking._inside = searched
    assert seen[0] == 20_000 and seen[-1] <= 200 and len(seen) == 3


@pytest.mark.parametrize("seconds", [60, 3_600, 86_400])
def test_slots_follow_the_size_of_the_bars(spark, seconds):
    """No key has more bars in a slot than in a chunk, whatever the distance of bars."""
    start = dt.datetime(2024, 1, 1)
    rows = [("A", g, start + dt.timedelta(seconds=seconds * i), float(i))
            for g, n in (("fine", 3_000), ("short", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, granularity string, ts timestamp, close double")
    keys = ("symbol", "granularity")
    assert series.spacing(df, keys) == seconds
    slots = df.groupBy(*keys, series.slot_of("ts", seconds, 100)).count()
    assert slots.agg(F.max("count")).first()[0] <= 100
    out = number_bars(df, keys, bar_seconds=None, chunk_bars=100)
    assert out.where("rn <> close").count() == 0
    assert {(r.granularity, r.n) for r in out.collect()} == {("fine", 3_000), ("short", 3)}
