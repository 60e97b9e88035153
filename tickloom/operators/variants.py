"""The lattice of AND-combinations, its warm-up, and the chronological split."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import SEPARATOR, class_has_volume
from tickloom.operators.signals import Signal

MIN_WINDOW_BARS = 30


@dataclass(frozen=True)
class Variant:
    mask: int
    components: tuple[str, ...]
    warmup: int
    params: str

    @property
    def strategy(self) -> str:
        return SEPARATOR.join(self.components)


def lattice(signals: Sequence[Signal], *, combinations: bool = True) -> list[Variant]:
    """Every non-empty subset of the configured signals: singles first, then by size and name.

    ``2**k - 1`` entries for ``k`` configured signals; the size never depends on the data.
    """
    made = []
    for mask in range(1, 2 ** len(signals)):
        parts = [s for place, s in enumerate(signals) if mask >> place & 1]
        if len(parts) > 1 and not combinations:
            continue
        names = tuple(s.name for s in parts)
        own = {s.name: dict(s.params) for s in parts}
        params = own[names[0]] if len(parts) == 1 else {"components": list(names), **own}
        made.append(Variant(mask, names, max(s.warmup for s in parts), json.dumps(params)))
    return sorted(made, key=lambda v: (len(v.components), v.strategy))


def volume_mask(signals: Sequence[Signal]) -> int:
    return sum(1 << place for place, s in enumerate(signals) if s.requires_volume)


VARIANT_FIELDS = {
    "mask": "int",
    "generation": "int",
    "strategy": "string",
    "components": "array<string>",
    "n_components": "int",
    "strategy_kind": "string",
    "warmup": "int",
    "params": "string",
}


def variant_array(variants: Sequence[Variant], *fields: str) -> Column:
    """The lattice (or some fields of it) as one constant array, for use inside a projection.

    One JSON literal keeps the plan small; it is folded to a constant before execution.
    """
    chosen = fields or tuple(VARIANT_FIELDS)
    rows = [
        {
            "mask": v.mask,
            "generation": place,
            "strategy": v.strategy,
            "components": v.components,
            "n_components": len(v.components),
            "strategy_kind": "single" if len(v.components) == 1 else "combo",
            "warmup": v.warmup,
            "params": v.params,
        }
        for place, v in enumerate(variants)
    ]
    text = json.dumps([{f: row[f] for f in chosen} for row in rows])
    kinds = ",".join(f"{f}:{VARIANT_FIELDS[f]}" for f in chosen)
    return F.from_json(F.lit(text), f"array<struct<{kinds}>>")


def available_mask(signals: Sequence[Signal]) -> Column:
    """Bits of the signals that apply to a symbol: volume signals need a class and a tape.

    Reads ``asset_class`` (NULL means unknown, treated as having volume) and ``live_volume``.
    """
    everything = 2 ** len(signals) - 1
    usable = F.coalesce(class_has_volume(F.col("asset_class")), F.lit(True)) & (
        F.col("live_volume") > 0
    )
    return F.when(usable, F.lit(everything)).otherwise(
        F.lit(everything & ~volume_mask(signals))
    )


def expand_variants(symbols: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    """One row per (symbol, applicable variant); needs ``available`` on the symbol rows."""
    fits = F.filter(
        variant_array(variants),
        lambda v: v["mask"].bitwiseAND(F.col("available")) == v["mask"],
    )
    return symbols.withColumn("_v", F.explode(fits)).select(*symbols.columns, "_v.*")


def warm_start(n: Column, warmup: Column) -> Column:
    return F.least(F.greatest(warmup, F.lit(0)), n).cast("long")


def split_at(n: Column, warmup: Column, train_fraction: float) -> Column:
    """First out-of-sample position: the split skips the warm-up and rounds half to even."""
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must be between 0 and 1 (exclusive)")
    start = warm_start(n, warmup)
    usable = n - start
    inside = F.rint(usable * F.lit(train_fraction)).cast("long")
    return start + F.least(F.greatest(inside, F.lit(0)), usable)
