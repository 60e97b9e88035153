"""Position accounting: next-open fills with costs, scored on full / is / oos windows.

A position never needs a running simulation. For a variant, the position at bar ``t`` is the
signal of bar ``t-1`` and the previous position is the signal of ``t-2`` (both flat at a window's
start), so equity grows by a factor that depends on two neighbouring bars only. Three facts
follow and keep the plan small:

* flat bars have factor exactly 1, so only *active* bars of a variant are expanded;
* sums (log growth, returns, exits, held bars) combine map-side;
* drawdown and the entry price of an open trade are carried between chunks as summaries.

The bars move once, to (symbol, chunk); expansion by variant and window happens after that
shuffle and is never sent over the network row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import periods_per_year
from tickloom.functions.series import CHUNK_BARS, by_chunk, carried, so_far, spread
from tickloom.operators.signals import Signal, pack
from tickloom.operators.variants import (
    MIN_WINDOW_BARS,
    Variant,
    available_mask,
    expand_variants,
    split_at,
    variant_array,
    warm_start,
)

WINDOWS = ("full", "is", "oos")

# A window of this many returns needs this many live ones to get a Sharpe ratio.
SPARSE_WINDOW_RETURNS = 30
MIN_LIVE_RETURNS = 5


@dataclass(frozen=True)
class Costs:
    """Starting cash, cost rates per side in basis points, and the in-sample share."""

    initial_cash: float = 10_000.0
    fee_bps: float = 10.0
    slippage_bps: float = 5.0
    train_fraction: float = 0.7

    def __post_init__(self) -> None:
        if self.initial_cash <= 0:
            raise ValueError("initial_cash must be positive")

    @property
    def fee(self) -> float:
        return self.fee_bps / 1e4

    @property
    def slip(self) -> float:
        return self.slippage_bps / 1e4

    @property
    def buy(self) -> float:
        """Cash paid per unit bought, over the open price."""
        return (1.0 + self.slip) * (1.0 + self.fee)

    @property
    def sell(self) -> float:
        """Cash received per unit sold, over the open price."""
        return (1.0 - self.slip) * (1.0 - self.fee)


KEY = ("symbol", "chunk", "mask", "window")
SERIES = ("symbol", "mask", "window")


def with_history(
    signals_df: DataFrame, signals: Sequence[Signal], *, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Bars in their chunk with the packed signals of the two bars before and the last close."""
    narrow = signals_df.select(
        "symbol", "ts", "rn", "n", "open", "close", pack(signals).alias("bits")
    )
    w = Window.partitionBy("symbol", "chunk").orderBy("rn")
    return (
        by_chunk(spread(narrow, 2, chunk_bars=chunk_bars))
        .withColumn("bits1", F.coalesce(F.lag("bits", 1).over(w), F.lit(0)))
        .withColumn("bits2", F.coalesce(F.lag("bits", 2).over(w), F.lit(0)))
        .withColumn("prev_close", F.lag("close").over(w))
        .where("core")
        .drop("core", "bits")
    )


def _covers(bits: Column, mask: Column) -> Column:
    return bits.bitwiseAND(mask) == mask


def _window_starts(train_fraction: float) -> Column:
    """Windows that contain the bar, each with the position where it starts."""
    n, rn, warmup = F.col("n"), F.col("rn"), F.col("warmup")
    start, split = warm_start(n, warmup), split_at(n, warmup, train_fraction)

    def tag(name: str, begin: Column) -> Column:
        return F.struct(F.lit(name).alias("window"), begin.cast("long").alias("start"))

    held_out = F.when(rn >= split, tag("oos", split)).when(rn >= start, tag("is", start))
    return F.array_compact(F.array(tag("full", F.lit(0)), held_out))


def _with_positions(df: DataFrame, costs: Costs) -> DataFrame:
    """``pos``, ``was`` and the growth factor of each expanded bar.

    A price of zero gives no factor; the input gate keeps its symbol from being scored, and its bars
    cannot end the scoring of the others.
    """
    age = F.col("rn") - F.col("start")
    mask = F.col("mask")
    pos = (age >= 1) & _covers(F.col("bits1"), mask)
    was = (age >= 2) & _covers(F.col("bits2"), mask)
    enter, leave = F.col("pos") & ~F.col("was"), ~F.col("pos") & F.col("was")
    factor = (
        F.when(enter, F.try_divide(F.col("close"), F.col("open") * costs.buy))
        .when(leave, F.try_divide(F.col("open") * costs.sell, F.col("prev_close")))
        .when(F.col("pos"), F.try_divide(F.col("close"), F.col("prev_close")))
        .otherwise(F.lit(1.0))
    )
    return df.withColumns({"pos": pos, "was": was}).withColumns(
        {"factor": factor, "enter": enter, "leave": leave}
    )


def active_bars(history: DataFrame, variants: Sequence[Variant], costs: Costs) -> DataFrame:
    """Rows (symbol, chunk, mask, window, rn) where a variant holds, opens or closes a position."""
    live = F.filter(
        variant_array(variants, "mask", "warmup"),
        lambda v: _covers(F.col("bits1"), v["mask"]) | _covers(F.col("bits2"), v["mask"]),
    )
    per_variant = (
        history.where((F.col("bits1") != 0) | (F.col("bits2") != 0))
        .withColumn("_v", F.explode(live))
        .select("*", "_v.*")
        .drop("_v")
    )
    per_window = (
        per_variant.withColumn("_w", F.explode(_window_starts(costs.train_fraction)))
        .select("*", "_w.*")
        .drop("_w")
    )
    return _with_positions(per_window, costs).where("pos or was")


def chunk_scores(active: DataFrame, costs: Costs) -> DataFrame:
    """One summary per (symbol, chunk, mask, window): sums, drawdown pieces, open-trade edges."""
    w = so_far(Window.partitionBy(*KEY).orderBy("rn"))
    gained = F.col("factor") - 1
    trade = F.try_divide(F.col("open") * costs.sell, F.col("entry_open") * costs.buy) - 1
    return (
        active.withColumn("grown", F.log("factor"))
        .withColumn("level", F.sum("grown").over(w))
        .withColumn("entry_open", F.last(F.when(F.col("enter"), F.col("open")), True).over(w))
        .withColumn("peak", F.max("level").over(w))
        .groupBy(*KEY)
        .agg(
            F.sum("grown").alias("total"),
            F.max("level").alias("top"),
            F.min("level").alias("bottom"),
            F.min(F.col("level") - F.col("peak")).alias("fall"),
            F.count_if("pos").alias("held"),
            F.count_if("leave").alias("exits"),
            F.count_if(F.col("leave") & (trade > 0)).alias("wins"),
            F.max(F.when(F.col("leave") & F.col("entry_open").isNull(), F.col("open"))).alias(
                "orphan_exit"
            ),
            F.max_by("open", F.when(F.col("enter"), F.col("rn"))).alias("last_entry"),
            F.count(F.lit(1)).alias("n_active"),
            F.count_if(gained != 0).alias("n_live"),
            F.avg(gained).alias("mean_r"),
            (F.var_pop(gained) * F.count(F.lit(1))).alias("m2_r"),
        )
    )


def window_scores(chunks: DataFrame, costs: Costs) -> DataFrame:
    """Combine chunk summaries in order into one row per (symbol, mask, window)."""
    before = carried(SERIES)
    n_active, mean_r = F.col("n_active"), F.col("mean_r")
    late = F.try_divide(F.col("orphan_exit") * costs.sell, F.col("entry_before") * costs.buy) - 1
    return (
        chunks.withColumn("offset", F.coalesce(F.sum("total").over(before), F.lit(0.0)))
        .withColumn("entry_before", F.last("last_entry", True).over(before))
        .withColumn(
            "peak_before",
            F.greatest(F.lit(0.0), F.max(F.col("offset") + F.col("top")).over(before)),
        )
        .groupBy(*SERIES)
        .agg(
            F.sum("total").alias("total"),
            F.min(
                F.least(
                    F.col("fall"), F.col("offset") + F.col("bottom") - F.col("peak_before")
                )
            ).alias("fall"),
            F.sum("held").alias("held"),
            F.sum("exits").alias("exits"),
            F.sum(F.col("wins") + F.coalesce((late > 0).cast("long"), F.lit(0))).alias("wins"),
            F.sum("n_active").alias("n_active"),
            F.sum("n_live").alias("n_live"),
            F.sum(n_active * mean_r).alias("sum_r"),
            F.sum(n_active * mean_r * mean_r).alias("sq_r"),
            F.sum("m2_r").alias("m2_r"),
        )
    )


def _tradable(price: Column) -> Column:
    return price.isNotNull() & ~F.isnan(price) & (price > 0) & (price < float("inf"))


def _bound_name(window: str, warmup: int | None) -> str:
    return window if warmup is None else f"{window}_{warmup}"


def symbol_bounds(
    signals_df: DataFrame, variants: Sequence[Variant], train_fraction: float
) -> DataFrame:
    """Per symbol: length, end points, and for each distinct warm-up the prices at its windows.

    The columns are a fixed handful per distinct warm-up, so this is one aggregation with a
    map-side part and one output row per symbol.
    """
    n, rn = F.col("n"), F.col("rn")
    columns = [
        F.max("n").alias("n"),
        F.max("live_volume").alias("live_volume"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
    ]

    def window(name: str, start: Column, stop: Column) -> list[Column]:
        usable = _tradable(F.col("open")) & (rn >= start) & (rn < stop)
        return [
            F.min_by("open", F.when(usable, rn)).alias(f"open_{name}"),
            F.max(F.when(rn == stop - 1, F.col("close"))).alias(f"close_{name}"),
        ]

    columns += window("full", F.lit(0), n)
    for warmup in sorted({v.warmup for v in variants}):
        start = warm_start(n, F.lit(warmup))
        split = split_at(n, F.lit(warmup), train_fraction)
        columns += window(_bound_name("is", warmup), start, split)
        columns += window(_bound_name("oos", warmup), split, n)
        columns.append(F.max(F.when(rn == split, F.col("ts"))).alias(f"split_{warmup}"))
    return signals_df.groupBy("symbol").agg(*columns)


def _pick(prefix: str, window: str, warmups: Sequence[int]) -> Column:
    picked = F.lit(None)
    for warmup in warmups:
        name = f"{prefix}_{warmup}" if window == "" else f"{prefix}_{window}_{warmup}"
        picked = F.when(F.col("warmup") == warmup, F.col(name)).otherwise(picked)
    return picked


def scored_lattice(
    bounds: DataFrame,
    catalog: DataFrame,
    variants: Sequence[Variant],
    signals: Sequence[Signal],
    train_fraction: float,
) -> DataFrame:
    """One row per (symbol, applicable variant, window) with its bar count and edge prices."""
    warmups = sorted({v.warmup for v in variants})
    n = F.col("n")
    start = warm_start(n, F.col("warmup"))
    split = split_at(n, F.col("warmup"), train_fraction)
    rows = expand_variants(
        bounds.join(catalog.select("symbol", "asset_class"), "symbol", "left").withColumn(
            "available", available_mask(signals)
        ),
        variants,
    )

    def window(name: str, bars: Column, first: Column, last: Column) -> Column:
        return F.struct(
            F.lit(name).alias("window"),
            bars.alias("bars"),
            first.alias("first_open"),
            last.alias("last_close"),
        )

    windows = F.array(
        window("full", n, F.col("open_full"), F.col("close_full")),
        window("is", split - start, _pick("open", "is", warmups), _pick("close", "is", warmups)),
        window("oos", n - split, _pick("open", "oos", warmups), _pick("close", "oos", warmups)),
    )
    return (
        rows.withColumn("split_ts", _pick("split", "", warmups))
        .withColumn("periods", periods_per_year(F.col("asset_class")))
        .withColumn("_w", F.explode(windows))
        .select(
            "symbol", "mask", "generation", "strategy", "strategy_kind", "components",
            "n_components", "params", "warmup", "n", "start_ts", "end_ts", "split_ts",
            "periods", "_w.*",
        )
    )


def window_metrics(lattice_rows: DataFrame, scores: DataFrame, costs: Costs) -> DataFrame:
    """Metrics per (symbol, variant, window); windows too short to score carry NULLs."""
    joined = lattice_rows.join(scores, list(SERIES), "left")
    zero = F.lit(0)
    bars = F.col("bars")
    returns = bars - 1
    total = F.coalesce(F.col("total"), F.lit(0.0))
    active = F.coalesce(F.col("n_active"), zero)
    live = F.coalesce(F.col("n_live"), zero)
    exits = F.coalesce(F.col("exits"), zero)
    sum_r = F.coalesce(F.col("sum_r"), F.lit(0.0))

    # Moments of the active returns, then of the same returns padded with the flat bars' zeros.
    inner = F.coalesce(sum_r / F.nullif(active, zero), F.lit(0.0))
    within = F.coalesce(F.col("m2_r") + F.col("sq_r") - active * inner * inner, F.lit(0.0))
    spread_r = within + inner * inner * active * (returns - active) / F.nullif(returns, zero)
    deviation = F.sqrt(F.greatest(spread_r, F.lit(0.0)) / F.nullif(returns - 1, zero))
    scorable = (
        (returns >= 2)
        & (live >= 2)
        & ~((returns >= SPARSE_WINDOW_RETURNS) & (live < MIN_LIVE_RETURNS))
        & (deviation > 0)
    )
    sharpe = F.when(
        scorable, sum_r / returns / F.nullif(deviation, F.lit(0.0)) * F.sqrt(F.col("periods"))
    )
    bought = F.coalesce(F.col("last_close") / (F.col("first_open") * costs.buy) - 1, F.lit(0.0))
    years = bars / F.col("periods")
    scored = (F.col("window") == "full") | (bars >= MIN_WINDOW_BARS)

    def when_scored(value: Column) -> Column:
        return F.when(scored, value)

    return joined.select(
        *lattice_rows.columns,
        when_scored(F.expm1(total)).alias("total_return"),
        when_scored(F.exp(total / F.nullif(years, F.lit(0.0))) - 1).alias("cagr"),
        when_scored(bought).alias("buy_hold_return"),
        when_scored(F.expm1(F.least(F.coalesce(F.col("fall"), F.lit(0.0)), F.lit(0.0)))).alias(
            "max_drawdown"
        ),
        when_scored(sharpe).alias("sharpe"),
        when_scored(exits).cast("long").alias("n_trades"),
        when_scored(F.col("wins") / F.nullif(exits, zero)).alias("win_rate"),
        when_scored(F.coalesce(F.col("held"), zero) / bars).alias("exposure"),
    )


def score_variants(
    signals_df: DataFrame,
    catalog: DataFrame,
    signals: Sequence[Signal],
    variants: Sequence[Variant],
    costs: Costs,
    *,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """From resolved signals to one metrics row per (symbol, variant, window)."""
    history = with_history(signals_df, signals, chunk_bars=chunk_bars)
    chunks = chunk_scores(active_bars(history, variants, costs), costs)
    bounds = symbol_bounds(signals_df, variants, costs.train_fraction)
    rows = scored_lattice(bounds, catalog, variants, signals, costs.train_fraction)
    return window_metrics(rows, window_scores(chunks, costs), costs)


RUN_METRICS = (
    "total_return", "cagr", "buy_hold_return", "max_drawdown", "sharpe", "n_trades", "win_rate",
    "exposure",
)
WINDOW_METRICS = (
    "total_return", "buy_hold_return", "sharpe", "max_drawdown", "n_trades", "exposure",
)


def assemble_runs(
    metrics: DataFrame, costs: Costs, executed_at: Column, *, store_curves: bool = False
) -> DataFrame:
    """One run row per (symbol, strategy): full metrics plus six columns per held-out window."""
    def of(window: str, metric: str) -> Column:
        return F.max(F.when(F.col("window") == window, F.col(metric)))

    keys = (
        "symbol", "strategy", "strategy_kind", "components", "n_components", "generation",
        "mask", "params", "start_ts", "end_ts", "split_ts",
    )
    return (
        metrics.groupBy(*keys)
        .agg(
            F.max("n").alias("n_bars"),
            *[of("full", m).alias(m) for m in RUN_METRICS],
            *[of(w, m).alias(f"{w}_{m}") for w in ("is", "oos") for m in WINDOW_METRICS],
        )
        .withColumn("executed_at", executed_at)
        .withColumn("fee_bps", F.lit(costs.fee_bps))
        .withColumn("slippage_bps", F.lit(costs.slippage_bps))
        .withColumn("has_curve", (F.col("n_components") == 1) | F.lit(store_curves))
        .withColumn(
            "backtest_run_id",
            F.sha2(
                F.concat_ws("|", "symbol", "strategy", F.unix_micros("executed_at").cast("string")),
                256,
            ),
        )
    )


def curve_points(
    signals_df: DataFrame,
    signals: Sequence[Signal],
    variants: Sequence[Variant],
    costs: Costs,
    *,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """Per-bar position and equity of the given variants over the full window, with buy & hold.

    Every bar is emitted, flat ones too, so only variants that store a curve should be passed.
    """
    history = with_history(signals_df, signals, chunk_bars=chunk_bars)
    bars = _with_positions(
        history.withColumn("_v", F.explode(variant_array(variants, "mask", "strategy")))
        .select("*", "_v.*")
        .drop("_v")
        .withColumn("start", F.lit(0).cast("long")),
        costs,
    ).withColumn("grown", F.log("factor"))
    w = so_far(Window.partitionBy("symbol", "chunk", "mask").orderBy("rn"))
    local = bars.withColumn("level", F.sum("grown").over(w))
    offsets = bars.groupBy("symbol", "mask", "chunk").agg(F.sum("grown").alias("_total")).select(
        "symbol",
        "mask",
        "chunk",
        F.coalesce(F.sum("_total").over(carried(("symbol", "mask"))), F.lit(0.0)).alias("_off"),
    )
    entry = history.groupBy("symbol").agg(
        F.min_by("open", F.when(_tradable(F.col("open")), F.col("rn"))).alias("_open"),
        F.min(F.when(_tradable(F.col("open")), F.col("rn"))).alias("_from"),
    )
    cash = F.lit(costs.initial_cash)
    bought = F.when(
        F.col("rn") >= F.col("_from"), cash * F.col("close") / (F.col("_open") * costs.buy)
    ).otherwise(cash)
    return (
        local.join(offsets, ["symbol", "mask", "chunk"])
        .join(entry, "symbol")
        .select(
            "symbol",
            "strategy",
            "ts",
            "rn",
            "n",
            F.col("pos").cast("int").alias("position"),
            (cash * F.exp(F.col("_off") + F.col("level"))).alias("equity"),
            bought.alias("buy_hold_equity"),
        )
    )


def round_trips(active: DataFrame, variants: Sequence[Variant], costs: Costs) -> DataFrame:
    """Completed trades; a position still open on the last bar is not one.

    Entries and exits alternate, so an exit closes the latest entry before it: the one in its own
    chunk, or else the last entry any earlier chunk summary carries.
    """
    edge = F.struct(F.col("ts").alias("ts"), F.col("open").alias("open"))
    events = active.where("enter or leave")
    w = so_far(Window.partitionBy(*KEY).orderBy("rn"))
    local = events.withColumn("_entry", F.last(F.when(F.col("enter"), edge), True).over(w))
    opened = F.when(F.col("enter"), F.col("rn"))
    tails = events.groupBy(*KEY).agg(
        F.max(opened).alias("_rn"),
        F.max_by("ts", opened).alias("ts"),
        F.max_by("open", opened).alias("open"),
    )
    carry = tails.select(
        *KEY,
        F.last(F.when(F.col("_rn").isNotNull(), edge), True).over(carried(SERIES)).alias("_in"),
    )
    names = variant_array(variants, "mask", "strategy")
    entry = F.coalesce(F.col("_entry"), F.col("_in"))
    return (
        local.where("leave")
        .join(carry, list(KEY))
        .select(
            "symbol",
            F.filter(names, lambda v: v["mask"] == F.col("mask"))[0]["strategy"].alias("strategy"),
            "window",
            entry["ts"].alias("entry_ts"),
            F.col("ts").alias("exit_ts"),
            (entry["open"] * (1.0 + costs.slip)).alias("entry_fill"),
            (F.col("open") * (1.0 - costs.slip)).alias("exit_fill"),
            (F.try_divide(F.col("open") * costs.sell, entry["open"] * costs.buy) - 1).alias("return_pct"),
        )
    )


def best_variants(metrics: DataFrame) -> DataFrame:
    """Best excess per (symbol, window in {full, oos}); NULL never wins, first generated on ties."""
    excess = F.col("total_return") - F.col("buy_hold_return")
    w = Window.partitionBy("symbol", "window").orderBy(
        F.col("excess_return").desc_nulls_last(), "generation"
    )
    return (
        metrics.where(F.col("window").isin("full", "oos"))
        .withColumn("excess_return", excess)
        .where("excess_return is not null")
        .withColumn("_place", F.row_number().over(w))
        .where("_place = 1")
        .select("symbol", "window", "strategy", "excess_return")
    )
