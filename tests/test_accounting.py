import math

import pytest
from pyspark.sql import functions as F

from tests.walk import account, bars, frame, wave
from tickloom.functions.series import number_bars
from tickloom.operators.accounting import (
    Costs,
    active_bars,
    assemble_runs,
    best_variants,
    curve_points,
    round_trips,
    score_variants,
    with_history,
)
from tickloom.operators.signals import Signal, configure, resolve_signals, signal_base
from tickloom.operators.variants import lattice, split_at, volume_mask

CATALOG = "symbol string, asset_class string"
FREE = Costs(fee_bps=0, slippage_bps=0)


def given(spark, series, warmup=0):
    """Bars of symbol A with a signal column of our own."""
    closes, opens, flags = series
    rows = bars(closes, "A", opens=opens)
    df = spark.createDataFrame(
        [(*r, f) for r, f in zip(rows, flags)],
        "symbol string, ts timestamp, open double, high double, low double, close double, "
        "volume double, sig_own int",
    )
    out = number_bars(df).withColumn("live_volume", F.lit(1))
    return out, [Signal("own", {}, warmup, 0, "frame")]


def metrics(spark, series, costs=FREE, chunk=4096, warmup=0, asset_class="equity"):
    df, signals = given(spark, series, warmup)
    catalog = spark.createDataFrame([("A", asset_class)], CATALOG)
    rows = score_variants(df, catalog, signals, lattice(signals), costs, chunk_bars=chunk).collect()
    return {r.window: r for r in rows}


def same(row, want):
    for name in ("total_return", "cagr", "buy_hold_return", "max_drawdown", "sharpe", "win_rate",
                 "exposure"):
        got, expected = row[name], want[name]
        assert (got is None) == (expected is None), name
        if got is not None:
            assert got == pytest.approx(expected, rel=1e-9, abs=1e-12), name
    assert row["n_trades"] == want["n_trades"]


@pytest.mark.parametrize("chunk", [5, 31, 4096])
def test_windows_match_a_sequential_walk(spark, chunk):
    closes = wave(140)
    opens = [c * (1 + 0.004 * math.cos(i)) for i, c in enumerate(closes)]
    flags = [int(math.sin(i / 3.1) + math.sin(i * 1.7) > 0.2) for i in range(140)]
    got = metrics(spark, (closes, opens, flags), Costs(), chunk, warmup=20)
    split = 20 + round(120 * 0.7)
    for window, lo, hi in (("full", 0, 140), ("is", 20, split), ("oos", split, 140)):
        assert got[window].bars == hi - lo
        same(got[window], account(opens[lo:hi], closes[lo:hi], flags[lo:hi]))


@pytest.mark.parametrize("chunk", [4, 4096])
def test_long_holds_cross_chunks(spark, chunk):
    """A position opened in one chunk is held through others and closed in a later one."""
    closes = wave(60)
    flags = [1 if 3 <= i < 27 or i >= 50 else 0 for i in range(60)]
    row = metrics(spark, (closes, closes, flags), Costs(), chunk)["full"]
    same(row, account(closes, closes, flags))
    df, signals = given(spark, (closes, closes, flags))
    variants = lattice(signals)
    history = with_history(df, signals, chunk_bars=chunk)
    trips = round_trips(active_bars(history, variants, Costs()), variants, Costs()).where(
        "window = 'full'").collect()
    assert [round(t.return_pct, 12) for t in trips] == [
        round(x, 12) for x in account(closes, closes, flags)["trades"]]
    assert trips[0].entry_fill == pytest.approx(closes[4] * 1.0005)
    assert trips[0].exit_fill == pytest.approx(closes[28] * 0.9995)


def test_constant_price_costs_are_the_only_loss(spark):
    flags = [0, 1, 1, 0, 0] * 8
    row = metrics(spark, ([100.0] * 40, [100.0] * 40, flags), Costs())["full"]
    factor = (1 - 0.0005) * (1 - 0.001) / ((1 + 0.0005) * (1 + 0.001))
    assert row.n_trades == 8
    assert row.total_return == pytest.approx(factor**8 - 1, rel=1e-12)
    assert row.win_rate == 0 and row.exposure == pytest.approx(16 / 40)


def test_flat_variant_scores_zero_not_null(spark):
    row = metrics(spark, (wave(40), wave(40), [0] * 40))["full"]
    assert (row.total_return, row.max_drawdown, row.n_trades, row.exposure) == (0, 0, 0, 0)
    assert row.sharpe is None and row.win_rate is None


def test_last_bar_signal_never_fills(spark):
    row = metrics(spark, (wave(40), wave(40), [0] * 39 + [1]))["full"]
    assert row.exposure == 0 and row.total_return == 0


def test_sparse_long_window_has_no_sharpe(spark):
    closes = [100.0 + i for i in range(40)]
    flags = [0] * 10 + [1, 1, 1] + [0] * 27
    assert metrics(spark, (closes, closes, flags))["full"].sharpe is None


@pytest.mark.parametrize("bars_in,scored", [(42, False), (43, True)])
def test_thirty_bar_rule(spark, bars_in, scored):
    """43 bars leave 30 in sample (rounding 30.1), 42 leave 29."""
    got = metrics(spark, (wave(bars_in), wave(bars_in), [1] * bars_in))
    assert (got["is"].total_return is not None) == scored
    assert got["oos"].total_return is None and got["oos"].n_trades is None
    assert got["full"].total_return is not None


def test_sharpe_scale_follows_the_class(spark):
    series = (wave(60), wave(60), [1] * 60)
    ratio = (metrics(spark, series, asset_class="crypto")["full"].sharpe
             / metrics(spark, series)["full"].sharpe)
    assert ratio == pytest.approx(math.sqrt(365 / 252))


def test_split_rounds_half_to_even(spark):
    n = F.col("id")
    frame_ = spark.range(1, 200)
    rows = frame_.select("id", split_at(n, F.lit(20), 0.7).alias("s")).collect()
    for r in rows:
        warm = min(20, r.id)
        assert r.s == warm + round((r.id - warm) * 0.7)
    with pytest.raises(ValueError):
        split_at(n, F.lit(0), 1.0)


def test_lattice_sizes_and_order():
    signals = configure()
    everything = lattice(signals)
    assert len(everything) == 31
    names = [v.strategy for v in everything]
    assert names[:2] == ["fibonacci", "macd"] and names[-1].count("+") == 4
    assert names == sorted(names, key=lambda s: (s.count("+"), s))
    assert len([v for v in everything if v.mask & volume_mask(signals) == 0]) == 15
    assert [len(v.components) for v in lattice(signals, combinations=False)] == [1] * 5
    pair = next(v for v in everything if v.strategy == "macd+rsi_reversion")
    assert pair.warmup == 35 and '"components"' in pair.params


def test_hot_symbol_is_scored_like_any_other(spark):
    """One symbol holds most rows; its chunks are separate groups and the result is unchanged."""
    quick = [{"name": "macd", "params": {"fast": 3, "slow": 7, "signal": 4}},
             {"name": "sma_cross", "params": {"fast": 4, "slow": 9}}]
    signals = configure(quick)
    variants = lattice(signals)
    df = frame(spark, bars(wave(300), "HOT"), bars(wave(40, shift=3), "COLD"))
    catalog = spark.createDataFrame([("HOT", "crypto"), ("COLD", "equity")], CATALOG)

    def score(chunk):
        resolved = resolve_signals(signal_base(df, signals, chunk_bars=chunk), signals,
                                   chunk_bars=chunk)
        rows = score_variants(resolved, catalog, signals, variants, Costs(), chunk_bars=chunk)
        return {(r.symbol, r.strategy, r.window): r for r in rows.collect()}

    small, large = score(16), score(4096)
    assert len(small) == 2 * 3 * 3 and small.keys() == large.keys()
    for key, row in small.items():
        for name in ("total_return", "sharpe", "max_drawdown", "exposure"):
            a, b = row[name], large[key][name]
            assert (a is None) == (b is None)
            assert a is None or a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_curves_and_runs(spark):
    closes = wave(64)
    flags = [int(i % 9 < 5) for i in range(64)]
    df, signals = given(spark, (closes, closes, flags))
    variants = lattice(signals)
    points = curve_points(df, signals, variants, Costs(), chunk_bars=10).orderBy("ts").collect()
    want = account(closes, closes, flags)["equity"]
    assert [p.equity for p in points] == pytest.approx(want, rel=1e-12)
    assert points[0].buy_hold_equity == pytest.approx(10_000 / (1.0005 * 1.001))
    catalog = spark.createDataFrame([("A", "equity")], CATALOG)
    scored = score_variants(df, catalog, signals, variants, Costs())
    run = assemble_runs(scored, Costs(), F.lit("2024-01-01").cast("timestamp")).first()
    assert run.has_curve and run.n_bars == 64 and len(run.backtest_run_id) == 64
    assert run.is_total_return is not None and run.oos_total_return is None
    best = best_variants(scored).collect()
    assert [b.window for b in best] == ["full"]


def test_costs_reject_empty_cash():
    with pytest.raises(ValueError):
        Costs(initial_cash=0)
