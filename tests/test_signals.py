import pytest
from pyspark.sql import functions as F

from tests.walk import bars, frame, latch, macd_signal, rsi, wave
from tickloom.operators.indicators import price_changes
from tickloom.functions.series import chunk_order, number_bars, spread
from tickloom.operators.signals import (
    DEFAULT_SIGNALS,
    Recursion,
    Signal,
    align_external,
    assert_bars,
    assert_binary,
    configure,
    cutler_rsi,
    known_signals,
    register,
    resolve_signals,
    signal_base,
)

QUICK = [
    {"name": "macd", "params": {"fast": 3, "slow": 7, "signal": 4}},
    {"name": "rsi_reversion", "params": {"period": 5, "entry_below": 40, "exit_above": 60}},
    {"name": "sma_cross", "params": {"fast": 4, "slow": 9}},
    {"name": "fibonacci", "params": {"window": 12, "ratio": 0.618}},
    {"name": "volume_breakout",
     "params": {"price_window": 5, "volume_window": 6, "volume_mult": 1.2},
     "requires_volume": True},
]


def resolved(df, entries, chunk):
    signals = configure(entries)
    return resolve_signals(signal_base(df, signals, chunk_bars=chunk), signals, chunk_bars=chunk)


def test_rsi_known_answer(spark):
    closes = [10, 9, 8, 7, 8, 9, 10, 10, 10]
    rows = price_changes(spread(number_bars(frame(spark, bars(closes))), 3)).withColumn(
        "rsi", cutler_rsi(chunk_order(), 2)).where("core").orderBy("rn").collect()
    assert [r.rsi for r in rows] == [None, None, 0, 0, 50, 100, 100, 100, None]
    entries = [{"name": "rsi_reversion",
                "params": {"period": 2, "entry_below": 30, "exit_above": 70}}]
    out = resolved(frame(spark, bars(closes)), entries, 4).orderBy("rn").collect()
    assert [r.sig_rsi_reversion for r in out] == [0, 0, 1, 1, 1, 0, 0, 0, 0]


@pytest.mark.parametrize("chunk", [16, 50, 4096])
def test_all_signals_match_a_sequential_walk(spark, chunk):
    closes = wave(170)
    volumes = [3.0 if i % 7 == 0 else 1.0 for i in range(170)]
    df = frame(spark, bars(closes, "A", volumes=volumes))
    rows = resolved(df, QUICK, chunk).orderBy("rn").collect()
    assert [r.sig_macd for r in rows] == macd_signal(closes, 3, 7, 4)
    assert [r.sig_rsi_reversion for r in rows] == latch(rsi(closes, 5), 40, 60)
    for i, r in enumerate(rows):
        def mean(v, n):
            return sum(v[i - n + 1:i + 1]) / n if i >= n - 1 else None

        if i >= 8:
            assert r.sig_sma_cross == int(mean(closes, 4) > mean(closes, 9))
        else:
            assert r.sig_sma_cross == 0
        top = max(closes[i - 11:i + 1]) if i >= 11 else None
        low = min(closes[i - 11:i + 1]) if i >= 11 else None
        assert r.sig_fibonacci == int(top is not None and closes[i] > top - (top - low) * 0.618)
        on = i >= 5 and closes[i] > mean(closes, 5) and volumes[i] > 1.2 * mean(volumes, 6)
        assert r.sig_volume_breakout == int(on)
    assert {r.sig_macd for r in rows} == {0, 1}


def test_latch_is_carried_over_silent_chunks(spark):
    closes = [50 - i for i in range(8)] + [42.0] * 60 + [42 + i for i in range(1, 9)]
    want = latch(rsi(closes, 5), 40, 60)
    rows = resolved(frame(spark, bars(closes)), QUICK[1:2], 8).orderBy("rn").collect()
    assert [r.sig_rsi_reversion for r in rows] == want
    assert sum(want) > 60


def test_flat_prices_give_no_macd(spark):
    rows = resolved(frame(spark, bars([0.1] * 80)), QUICK[:1], 16).collect()
    assert {r.sig_macd for r in rows} == {0}


def test_equal_spans_in_macd(spark):
    closes = wave(90)
    entries = [{"name": "macd", "params": {"fast": 4, "slow": 9, "signal": 4}}]
    rows = resolved(frame(spark, bars(closes)), entries, 16).orderBy("rn").collect()
    assert [r.sig_macd for r in rows] == macd_signal(closes, 4, 9, 4)


def test_past_signals_ignore_the_future(spark):
    closes = wave(120)
    changed = closes[:80] + [x * 3 for x in closes[80:]]
    a = resolved(frame(spark, bars(closes)), QUICK, 32).where("rn < 80")
    b = resolved(frame(spark, bars(changed)), QUICK, 32).where("rn < 80")
    names = ["rn", *[c for c in a.columns if c.startswith("sig_")]]
    assert a.select(*names).exceptAll(b.select(*names)).isEmpty()


def test_existing_average_columns_are_reused(spark):
    df = frame(spark, bars(wave(40))).withColumn("sma_4", F.lit(2.0)).withColumn(
        "sma_9", F.lit(1.0))
    assert {r.sig_sma_cross for r in resolved(df, QUICK[2:3], 64).collect()} == {1}


def test_missing_volume_is_flat(spark):
    df = frame(spark, bars(wave(40), volumes=[None] * 40))
    rows = resolved(df, QUICK[4:], 64).collect()
    assert {(r.sig_volume_breakout, r.live_volume) for r in rows} == {(0, 0)}


@pytest.mark.parametrize("name,params", [
    ("sma_cross", {"fast": 5, "slow": 5}), ("sma_cross", {"fast": 0, "slow": 5}),
    ("macd", {"fast": 9, "slow": 5, "signal": 3}), ("macd", {"fast": 3, "slow": 5, "signal": 0}),
    ("rsi_reversion", {"period": 0, "entry_below": 30, "exit_above": 50}),
    ("rsi_reversion", {"period": 5, "entry_below": 50, "exit_above": 50}),
    ("volume_breakout", {"price_window": 0, "volume_window": 5, "volume_mult": 1}),
    ("volume_breakout", {"price_window": 5, "volume_window": 5, "volume_mult": 0}),
    ("fibonacci", {"window": 1, "ratio": 0.5}), ("fibonacci", {"window": 5, "ratio": 1.0}),
    ("nothing_like_it", {}),
])
def test_bad_parameters_are_refused(name, params):
    with pytest.raises(ValueError):
        configure([{"name": name, "params": params}])


def test_registry_refuses_repeats():
    with pytest.raises(ValueError):
        configure([QUICK[0], QUICK[0]])
    with pytest.raises(ValueError):
        register("macd")(lambda params: None)
    assert [s.name for s in configure(DEFAULT_SIGNALS)] == sorted(s["name"] for s in QUICK)


def test_input_checks(spark):
    df = frame(spark, bars([1, 2, 3]))
    with pytest.raises(ValueError):
        assert_bars(df.drop("open"))
    with pytest.raises(ValueError):
        assert_bars(df.where("close > 9"))
    assert_binary(df.withColumn("s", F.lit(1)), ["s"])
    with pytest.raises(ValueError):
        assert_binary(df.withColumn("s", F.col("close").cast("int")), ["s"])
    outside = df.select("symbol", "ts", F.lit(1).alias("signal")).where("close < 3")
    good, rejects = align_external(df, outside)
    assert good.count() == 2 and [r.reason for r in rejects.collect()] == ["no signal for bar"]


def overshoot(params):
    """A signal of our own: a damped oscillator driven by the close, long while it is above zero."""
    damp = params["damp"]
    recursion = Recursion(
        matrix=((1.0, 0.1), (-0.1, damp)),
        inputs=lambda: (F.lit(0.0), F.col("close") - F.col("close0")),
        decide=lambda state: state[0] > 0,
    )
    return Signal("overshoot", params, 5, 0, "linear", recursion=recursion)


@pytest.mark.parametrize("chunk", [3, 16, 4096])
def test_a_signal_of_ones_own_over_chunks(spark, chunk):
    if "overshoot" not in known_signals():
        register("overshoot")(overshoot)
    signals = configure([{"name": "overshoot", "params": {"damp": 0.8}}])
    series = {s: wave(n, shift=i) for i, (s, n) in enumerate({"A": 61, "B": 1, "C": 16}.items())}
    df = frame(spark, *[bars(c, s) for s, c in series.items()]).repartition(3)
    out = resolve_signals(signal_base(df, signals, chunk_bars=chunk), signals, chunk_bars=chunk)
    got = {(r.symbol, r.rn): r.sig_overshoot for r in out.collect()}
    for symbol, closes in series.items():
        x, v = 0.0, 0.0
        for i, close in enumerate(closes):
            x, v = x + 0.1 * v, -0.1 * x + 0.8 * v + close - closes[0]
            assert got[symbol, i] == int(x > 0), (symbol, i)
    assert {0, 1} == set(got.values())


def test_own_signals_are_scored_beside_built_in_ones(spark):
    signals = [overshoot({"damp": 0.8}), *configure([{"name": "sma_cross", "params": {"fast": 2, "slow": 3}}])]
    out = resolve_signals(signal_base(frame(spark, bars(wave(40))), signals), signals)
    assert {"sig_overshoot", "sig_sma_cross"} <= set(out.columns)
    assert not [c for c in out.columns if c.startswith(("z_", "in_", "x_", "_"))]
