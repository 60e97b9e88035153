"""Trading signals as 0/1 columns for all symbols in one plan, and the registry of signals.

A signal is the position wanted AFTER a bar's close. Undefined indicators are NULL and read as
flat. Three kinds cover the built-in set, and a fourth is there for signals of one's own:

``frame``  a boolean over bounded frames;
``latch``  an enter/exit event, held until the opposite event (unbounded memory);
``cross``  a pair of exponential averages against an exponential average of their difference;
``linear`` any linear recursion: a state vector ``x <- A x + u(bar)`` and a rule over the state.

Bounded frames are exact inside a chunk because of the look-back copies; unbounded memory is
carried between chunks through one summary row per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from tickloom.functions.series import (
    CHUNK_BARS,
    by_chunk,
    carried,
    chunk_order,
    full_mean,
    number_bars,
    so_far,
    spread,
    tiled,
    tiles,
    when_full,
)
from tickloom.operators.indicators import BAR_COLUMNS, price_changes

# Default signal parameters and execution costs.
DEFAULT_SIGNALS = (
    {"name": "sma_cross", "params": {"fast": 20, "slow": 50}},
    {"name": "macd", "params": {"fast": 12, "slow": 26, "signal": 9}},
    {"name": "rsi_reversion", "params": {"period": 14, "entry_below": 30, "exit_above": 50}},
    {
        "name": "volume_breakout",
        "params": {"price_window": 20, "volume_window": 20, "volume_mult": 1.5},
        "requires_volume": True,
    },
    {"name": "fibonacci", "params": {"window": 100, "ratio": 0.618}},
)


@dataclass(frozen=True)
class Recursion:
    """``x <- matrix @ x + inputs`` from a zero state, and the position that the state asks for.

    ``inputs`` are columns of a bar (``close0`` is the symbol's first close: prices relative to it
    start at zero); a NULL input counts as 0. ``decide`` gets the state's elements as columns.
    """

    matrix: Sequence[Sequence[float]]
    inputs: Callable[[], Sequence[Column]]
    decide: Callable[[Sequence[Column]], Column]


@dataclass(frozen=True)
class Signal:
    """One configured signal; ``build`` returns the column that its ``kind`` calls for.

    ``stage`` names columns a pass before ``build`` computes, such as the tiles of long frames.
    """

    name: str
    params: Mapping[str, Any]
    warmup: int
    lookback: int
    kind: str
    build: Callable[[WindowSpec, Collection[str]], Column] | None = None
    requires_volume: bool = False
    stage: Callable[[WindowSpec], dict[str, Column]] | None = None
    recursion: Recursion | None = None


Factory = Callable[[Mapping[str, Any]], Signal]
_FACTORIES: dict[str, Factory] = {}


def register(name: str) -> Callable[[Factory], Factory]:
    """Add a signal factory under ``name``; a taken name is an error."""

    def add(factory: Factory) -> Factory:
        if name in _FACTORIES:
            raise ValueError(f"signal {name!r} is already registered")
        _FACTORIES[name] = factory
        return factory

    return add


def known_signals() -> list[str]:
    return sorted(_FACTORIES)


def configure(entries: Sequence[Mapping[str, Any]] = DEFAULT_SIGNALS) -> list[Signal]:
    """Build the configured signals in name order; unknown or repeated names are errors."""
    chosen: dict[str, Signal] = {}
    for entry in entries:
        name = entry["name"]
        if name in chosen:
            raise ValueError(f"signal {name!r} is configured twice")
        if name not in _FACTORIES:
            raise ValueError(f"unknown signal {name!r}; known: {', '.join(known_signals())}")
        made = _FACTORIES[name](entry["params"])
        chosen[name] = Signal(
            **{**made.__dict__, "requires_volume": bool(entry.get("requires_volume", False))}
        )
    return [chosen[name] for name in sorted(chosen)]


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@register("sma_cross")
def _sma_cross(params: Mapping[str, Any]) -> Signal:
    fast, slow = params["fast"], params["slow"]
    _require(0 < fast < slow, "sma_cross needs 0 < fast < slow")

    def stage(w: WindowSpec) -> dict[str, Column]:
        return {
            **tiles("sma_fast", "close", w, fast, "sum"), **tiles("sma_slow", "close", w, slow, "sum")
        }

    def build(w: WindowSpec, have: Collection[str]) -> Column:
        def mean(name: str, size: int) -> Column:
            # An sma_<n> column the bars already carry is used instead.
            if f"sma_{size}" in have:
                return F.col(f"sma_{size}")
            return when_full(name, w, size, tiled(name, w, size, "sum") / size)

        return mean("sma_fast", fast) > mean("sma_slow", slow)

    return Signal("sma_cross", params, slow, slow, "frame", build, stage=stage)


@register("macd")
def _macd(params: Mapping[str, Any]) -> Signal:
    fast, slow, signal = params["fast"], params["slow"], params["signal"]
    _require(0 < fast < slow, "macd needs 0 < fast < slow")
    _require(signal >= 1, "macd needs signal >= 1")
    return Signal("macd", params, slow + signal, 0, "cross")


def cutler_rsi(w: WindowSpec, period: int) -> Column:
    """Cutler RSI over the ``gain`` and ``loss`` columns; NULL on a flat or incomplete window."""
    up, down = full_mean("gain", w, period), full_mean("loss", w, period)
    return 100.0 * up / F.nullif(up + down, F.lit(0.0))


@register("rsi_reversion")
def _rsi_reversion(params: Mapping[str, Any]) -> Signal:
    period, entry, leave = params["period"], params["entry_below"], params["exit_above"]
    _require(period >= 1, "rsi_reversion needs period >= 1")
    _require(entry < leave, "rsi_reversion needs entry_below < exit_above")

    def build(w: WindowSpec, have: Collection[str]) -> Column:
        rsi = cutler_rsi(w, period)
        return F.when(rsi < entry, 1).when(rsi > leave, 0)

    return Signal("rsi_reversion", params, period + 1, period + 1, "latch", build)


@register("volume_breakout")
def _volume_breakout(params: Mapping[str, Any]) -> Signal:
    price, volume, mult = params["price_window"], params["volume_window"], params["volume_mult"]
    _require(price >= 1 and volume >= 1, "volume_breakout needs windows >= 1")
    _require(mult > 0, "volume_breakout needs volume_mult > 0")

    def build(w: WindowSpec, have: Collection[str]) -> Column:
        return (F.col("close") > full_mean("close", w, price)) & (
            F.col("volume") > mult * full_mean("volume", w, volume)
        )

    longest = max(price, volume)
    return Signal("volume_breakout", params, longest, longest, "frame", build)


@register("fibonacci")
def _fibonacci(params: Mapping[str, Any]) -> Signal:
    window, part = params["window"], params["ratio"]
    _require(window >= 2, "fibonacci needs window >= 2")
    _require(0.0 < part < 1.0, "fibonacci needs 0 < ratio < 1")

    def stage(w: WindowSpec) -> dict[str, Column]:
        return {
            **tiles("fib_top", "high", w, window, "max"), **tiles("fib_bottom", "low", w, window, "min")
        }

    def build(w: WindowSpec, have: Collection[str]) -> Column:
        top = when_full("fib_top", w, window, tiled("fib_top", w, window, "max"))
        bottom = when_full("fib_bottom", w, window, tiled("fib_bottom", w, window, "min"))
        return F.col("close") > top - (top - bottom) * part

    return Signal("fibonacci", params, window, window, "frame", build, stage=stage)


# --- exponential averages ------------------------------------------------------------------
#
# With prices taken relative to the symbol's first close the recursion e <- q*e + (1-q)*x starts
# from zero. It is linear in the state, so a chunk computed from a zero state can be corrected
# afterwards by the decayed state that enters it.


def _decay(span: float) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def _spill(steps: Column, source: float, target: float) -> Column:
    """Sum over j=1..steps of target**(steps-j) * source**j."""
    if abs(source - target) < 1e-12:
        return steps * F.pow(F.lit(source), steps)
    scale = source / (source - target)
    return scale * (F.pow(F.lit(source), steps) - F.pow(F.lit(target), steps))


def _zero_state(params: Mapping[str, Any], schema_names: list[str]) -> Callable:
    fast, slow, signal = params["fast"], params["slow"], params["signal"]

    def ema(values: pd.Series, span: float) -> pd.Series:
        led = pd.concat([pd.Series([0.0]), values], ignore_index=True)
        return led.ewm(span=span, adjust=False).mean().iloc[1:].reset_index(drop=True)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rn", ignore_index=True)
        moved = frame["close"] - frame["close0"]
        frame["z_fast"], frame["z_slow"] = ema(moved, fast), ema(moved, slow)
        frame["z_line"] = ema(frame["z_fast"] - frame["z_slow"], signal)
        return frame[schema_names]

    return run


# --- linear recursions ---------------------------------------------------------------------
#
# A chunk maps the state that enters it to ``A**bars @ state + z``, where z is what it makes of a
# zero state. Such maps combine associatively, so they are scanned by doubling: inside a chunk over
# its bars, and over the chunks of a symbol, one row each.


def _scanned(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """All states of ``x <- matrix @ x + value`` from zero, in about log2(len) vector steps."""
    out, power, step = values.copy(), matrix, 1
    while step < len(out):
        out[step:] = out[step:] + out[:-step] @ power.T
        power, step = power @ power, 2 * step
    return out


def _local_states(matrix: np.ndarray, names: list[str]) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rn", ignore_index=True)
        given = np.array(frame["_u"].tolist(), float).reshape(len(frame), len(matrix))
        frame["_z"] = list(_scanned(matrix, np.nan_to_num(given, nan=0.0)))
        return frame[names]

    return run


def _with_local_states(base: DataFrame, s: Signal) -> DataFrame:
    given = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in s.recursion.inputs()])
    schema = StructType(list(base.schema.fields)).add("_z", ArrayType(DoubleType()))
    run = _local_states(np.array(s.recursion.matrix, float), schema.names)
    done = base.withColumn("_u", given).groupBy("symbol", "chunk").applyInPandas(run, schema)
    return done.withColumnRenamed("_z", f"z_{s.name}")


def _entering_states(base: DataFrame, s: Signal, chunk_bars: int) -> DataFrame:
    """The state that enters each chunk. All chunks but a symbol's last one are full."""
    power = np.linalg.matrix_power(np.array(s.recursion.matrix, float), chunk_bars)
    ends = base.groupBy("symbol", "chunk").agg(F.max_by(f"z_{s.name}", "rn").alias("_z"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk", ignore_index=True)
        after = _scanned(power, np.array(frame["_z"].tolist(), float))
        frame["_in"] = list(np.vstack([np.zeros_like(after[:1]), after[:-1]]))
        return frame[["symbol", "chunk", "_in"]]

    # one row for each chunk of a symbol
    kind = base.schema["chunk"].dataType.simpleString()
    carried_in = ends.groupBy("symbol").applyInPandas(run, f"symbol string, chunk {kind}, _in array<double>")
    return carried_in.withColumnRenamed("_in", f"in_{s.name}")


def _state(s: Signal, steps: Column, chunk_bars: int) -> Column:
    """The state after each bar: the local one and what is left of the one that entered."""
    matrix = np.array(s.recursion.matrix, float)

    @F.pandas_udf(ArrayType(DoubleType()))
    def finished(local: pd.Series, entered: pd.Series, steps: pd.Series) -> pd.Series:
        # a state only decays over the bars of one chunk
        powers = [np.eye(len(matrix))]
        for _ in range(min(chunk_bars, int(steps.max()))):
            powers.append(powers[-1] @ matrix)
        left = np.einsum(
            "nij,nj->ni", np.stack(powers)[steps.to_numpy(int)], np.array(entered.tolist(), float)
        )
        return pd.Series(list(np.array(local.tolist(), float) + left))

    return finished(f"z_{s.name}", f"in_{s.name}", steps)


def signal_base(
    bars: DataFrame, signals: Sequence[Signal], *, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Everything a bar can learn from its own chunk: frame signals, latched events, zero states.

    ``live_volume`` counts the symbol's bars with a non-zero volume (0 means no usable tape).
    One shuffle numbers the bars and one moves them to their chunks.
    """
    reusable = [c for c in bars.columns if c.startswith("sma_")]
    live = (F.coalesce(F.col("volume"), F.lit(0.0)) != 0).cast("long")
    numbered = number_bars(
        bars.select(*BAR_COLUMNS, *reusable),
        chunk_bars=chunk_bars,
        firsts={"close0": "close"},
        totals={"live_volume": live},
    )
    lookback = max([1, *[s.lookback for s in signals]])
    rows = price_changes(by_chunk(spread(numbered, lookback, chunk_bars=chunk_bars)))
    w = chunk_order()
    staged = {name: c for s in signals if s.stage for name, c in s.stage(w).items()}
    rows = rows.withColumns(staged) if staged else rows
    made = []
    for s in signals:
        if s.kind == "frame":
            made.append(F.coalesce(s.build(w, reusable), F.lit(False)).cast("int").alias(f"sig_{s.name}"))
        elif s.kind == "latch":
            made.append(s.build(w, reusable).cast("int").alias(f"ev_{s.name}"))
    kept = [*BAR_COLUMNS, "rn", "n", "chunk", "close0", "live_volume"]
    base = rows.select(*kept, "core", *made)
    for s in signals:
        if s.kind == "latch":
            # Events of look-back copies are exact or NULL, so they may only help.
            held = F.last(f"ev_{s.name}", ignorenulls=True).over(so_far(w))
            base = base.withColumn(f"ev_{s.name}", held)
    base = base.where("core").drop("core")
    for s in signals:
        if s.kind == "cross":
            schema = StructType(list(base.schema.fields))
            for name in ("z_fast", "z_slow", "z_line"):
                schema = schema.add(name, "double")
            base = base.groupBy("symbol", "chunk").applyInPandas(
                _zero_state(s.params, schema.names), schema
            )
            base = base.withColumnsRenamed(
                {f"z_{part}": f"z_{s.name}_{part}" for part in ("fast", "slow", "line")}
            )
        elif s.kind == "linear":
            base = _with_local_states(base, s)
    return base


def resolve_signals(
    base: DataFrame, signals: Sequence[Signal], *, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Finish latches and exponential crosses with the state carried into each chunk.

    Bars are only joined with one row per chunk; nothing is sorted or windowed again.
    """
    latches = [s for s in signals if s.kind == "latch"]
    crosses = [s for s in signals if s.kind == "cross"]
    out = base
    if latches or crosses:
        ends = base.groupBy("symbol", "chunk").agg(
            *[
                F.max_by(f"ev_{s.name}", "rn").alias(f"end_{s.name}") for s in latches
            ],
            *[
                F.max_by(f"z_{s.name}_{part}", "rn").alias(f"end_{s.name}_{part}")
                for s in crosses
                for part in ("fast", "slow", "line")
            ],
        )
        before = carried(("symbol",))
        recent = Window.partitionBy("symbol").orderBy("chunk")
        carry = ends.select(
            "symbol",
            "chunk",
            *[
                F.last(f"end_{s.name}", ignorenulls=True).over(before).alias(f"in_{s.name}")
                for s in latches
            ],
            *[
                _entering_state(s, recent.rowsBetween(-_reach(s, chunk_bars), -1), chunk_bars)
                .alias(f"in_{s.name}")
                for s in crosses
            ],
        )
        out = out.join(carry, ["symbol", "chunk"])
    for s in latches:
        state = F.coalesce(F.col(f"ev_{s.name}"), F.col(f"in_{s.name}"), F.lit(0))
        out = out.withColumn(f"sig_{s.name}", state.cast("int"))
    steps = (F.col("rn") - F.col("chunk") * chunk_bars + 1).cast("double")
    for s in crosses:
        out = out.withColumn(f"sig_{s.name}", _cross(s, steps))
    for s in signals:
        if s.kind == "linear":
            out = out.join(_entering_states(base, s, chunk_bars), ["symbol", "chunk"])
            out = out.withColumn(f"x_{s.name}", _state(s, steps.cast("int"), chunk_bars))
            state = [F.col(f"x_{s.name}")[i] for i in range(len(s.recursion.matrix))]
            decided = F.coalesce(s.recursion.decide(state), F.lit(False)).cast("int")
            out = out.withColumn(f"sig_{s.name}", decided)
    helpers = [c for c in out.columns if c.startswith(("ev_", "z_", "in_", "x_"))]
    return out.drop(*helpers, "close0")


def _reach(s: Signal, chunk_bars: int) -> int:
    """Chunks back after which a state is multiplied by less than exp(-1500), that is by zero."""
    slowest = max(_decay(s.params[k]) for k in ("fast", "slow", "signal"))
    return 1 if slowest <= 0 else math.ceil(1500.0 / (-math.log(slowest) * chunk_bars)) + 1


def _entering_state(s: Signal, before: WindowSpec, chunk_bars: int) -> Column:
    """Fold the chunk-end zero states of the earlier chunks (one row per chunk) in order."""
    fast, slow, line = (_decay(s.params[k]) for k in ("fast", "slow", "signal"))
    size = F.lit(float(chunk_bars))
    zero = F.struct(*[F.lit(0.0).alias(part) for part in ("fast", "slow", "line")])
    ends = F.collect_list(
        F.struct(*[F.col(f"end_{s.name}_{p}").alias(p) for p in ("fast", "slow", "line")])
    ).over(before)

    def advance(state: Column, end: Column) -> Column:
        pushed = (1.0 - line) * (
            _spill(size, fast, line) * state["fast"] - _spill(size, slow, line) * state["slow"]
        )
        return F.struct(
            (fast**chunk_bars * state["fast"] + end["fast"]).alias("fast"),
            (slow**chunk_bars * state["slow"] + end["slow"]).alias("slow"),
            (line**chunk_bars * state["line"] + pushed + end["line"]).alias("line"),
        )

    return F.aggregate(ends, zero, advance)


def _cross(s: Signal, steps: Column) -> Column:
    fast, slow, line = (_decay(s.params[k]) for k in ("fast", "slow", "signal"))
    state = F.col(f"in_{s.name}")
    z = {p: F.col(f"z_{s.name}_{p}") for p in ("fast", "slow", "line")}
    gap = (z["fast"] - z["slow"]) + (
        F.pow(F.lit(fast), steps) * state["fast"] - F.pow(F.lit(slow), steps) * state["slow"]
    )
    average = z["line"] + (
        F.pow(F.lit(line), steps) * state["line"]
        + (1.0 - line)
        * (_spill(steps, fast, line) * state["fast"] - _spill(steps, slow, line) * state["slow"])
    )
    return F.coalesce(gap > average, F.lit(False)).cast("int")


def signal_columns(signals: Sequence[Signal]) -> list[str]:
    return [f"sig_{s.name}" for s in signals]


def pack(signals: Sequence[Signal]) -> Column:
    """All component signals in one integer; bit ``i`` is the i-th signal in name order."""
    packed = F.lit(0)
    for place, s in enumerate(signals):
        packed = packed.bitwiseOR(F.shiftleft(F.col(f"sig_{s.name}"), place))
    return packed.cast("int")


def assert_binary(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a signal column holds anything but 0 or 1 (one aggregate over the data)."""
    bad = df.agg(
        *[
            F.count_if(F.coalesce(~F.col(c).isin(0, 1), F.lit(True))).alias(c)
            for c in columns
        ]
    ).first()
    wrong = [c for c in columns if bad[c]]
    if wrong:
        raise ValueError(f"signals must contain only 0 or 1: {wrong}")


def not_binary(df: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    """Per symbol, how many bars hold a signal value other than 0 or 1, and the signals concerned."""
    bad = {
        s.name: F.coalesce(~F.col(f"sig_{s.name}").isin(0, 1), F.lit(True)) for s in signals
    }
    counted = df.groupBy("symbol").agg(*[F.count_if(c).alias(name) for name, c in bad.items()])
    named = F.array_compact(F.array(*[F.when(F.col(n) > 0, F.lit(n)) for n in bad]))
    total = sum((F.col(n) for n in bad), F.lit(0))
    return counted.select("symbol", total.alias("n_bars"), named.alias("signals")).where("n_bars > 0")


def assert_bars(df: DataFrame, required: Sequence[str] = ("ts", "open", "close")) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"bars are missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("bars have no rows")


def align_external(bars: DataFrame, external: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attach an external 0/1 series to bars by (symbol, ts).

    Returns the aligned bars and the rejects: bars without a signal or with one outside {0, 1}.
    Nothing is filled in.
    """
    joined = bars.join(
        external.select("symbol", "ts", F.col("signal").alias("signal")), ["symbol", "ts"], "left"
    )
    good = F.coalesce(F.col("signal").isin(0, 1), F.lit(False))
    reason = F.when(F.col("signal").isNull(), "no signal for bar").otherwise("not 0 or 1")
    rejects = joined.where(~good).withColumn("reason", reason)
    return joined.where(good), rejects

