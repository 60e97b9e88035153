"""Bar-by-bar checks used by the tests: plain loops over one short series."""

from __future__ import annotations

import datetime as dt
import math

DAY0 = dt.datetime(2020, 1, 1)


def bars(closes, symbol="A", opens=None, highs=None, lows=None, volumes=None, day0=DAY0, step=1):
    opens = opens or closes
    rows = []
    for i, close in enumerate(closes):
        o = opens[i]
        high = highs[i] if highs else max(o, close)
        low = lows[i] if lows else min(o, close)
        volume = volumes[i] if volumes else 1.0
        rows.append((symbol, day0 + dt.timedelta(days=i * step), float(o), float(high),
                     float(low), float(close), None if volume is None else float(volume)))
    return rows


SCHEMA = (
    "symbol string, ts timestamp, open double, high double, low double, close double, "
    "volume double"
)


def frame(spark, *series):
    return spark.createDataFrame([row for rows in series for row in rows], SCHEMA)


def wave(n, base=100.0, size=20.0, period=17, drift=0.01, shift=0.0):
    return [base + size * math.sin(2 * math.pi * (i + shift) / period) + drift * i
            + ((i * 7919) % 13 - 6) * 0.35 for i in range(n)]


def ema(values, span):
    alpha, out, state = 2.0 / (span + 1), [], None
    for x in values:
        state = x if state is None else state + alpha * (x - state)
        out.append(state)
    return out


def macd_signal(closes, fast, slow, signal):
    line = [a - b for a, b in zip(ema(closes, fast), ema(closes, slow))]
    return [int(a > b) for a, b in zip(line, ema(line, signal))]


def rsi(closes, period):
    out = []
    for i in range(len(closes)):
        if i < period:
            out.append(None)
            continue
        deltas = [closes[j] - closes[j - 1] for j in range(i - period + 1, i + 1)]
        up, down = sum(max(d, 0) for d in deltas), sum(max(-d, 0) for d in deltas)
        out.append(None if up + down == 0 else 100.0 * up / (up + down))
    return out


def latch(values, entry, leave):
    held, out = 0, []
    for x in values:
        if held == 0 and x is not None and x < entry:
            held = 1
        elif held == 1 and x is not None and x > leave:
            held = 0
        out.append(held)
    return out


def account(opens, closes, signal, fee=0.001, slip=0.0005, cash=10_000.0, ppy=252):
    """Walk cash and units through one window and measure the result."""
    start, units, cost = cash, 0.0, 0.0
    equity, held, trades = [], 0, []
    for t in range(len(closes)):
        want = signal[t - 1] if t else 0
        if want and units == 0:
            cost, units, cash = cash, cash / (opens[t] * (1 + slip) * (1 + fee)), 0.0
        elif not want and units > 0:
            cash, units = units * opens[t] * (1 - slip) * (1 - fee), 0.0
            trades.append(cash / cost - 1)
        held += units > 0
        equity.append(cash + units * closes[t])
    returns = [b / a - 1 for a, b in zip(equity, equity[1:])]
    live = sum(r != 0 for r in returns)
    sharpe = None
    if len(returns) >= 2 and live >= 2 and not (len(returns) >= 30 and live < 5):
        mean = sum(returns) / len(returns)
        dev = math.sqrt(sum((r - mean) ** 2 for r in returns) / (len(returns) - 1))
        sharpe = mean / dev * math.sqrt(ppy) if dev > 0 else None
    peak, fall = -math.inf, 0.0
    for e in equity:
        peak = max(peak, e)
        fall = min(fall, e / peak - 1)
    n = len(closes)
    return {
        "total_return": equity[-1] / start - 1,
        "cagr": (equity[-1] / start) ** (ppy / n) - 1,
        "buy_hold_return": closes[-1] / (opens[0] * (1 + slip) * (1 + fee)) - 1,
        "max_drawdown": fall,
        "sharpe": sharpe,
        "n_trades": len(trades),
        "win_rate": sum(x > 0 for x in trades) / len(trades) if trades else None,
        "exposure": held / n,
        "equity": equity,
        "trades": trades,
    }
