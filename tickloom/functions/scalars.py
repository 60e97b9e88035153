"""Row-level expressions: names, guards, rounding, masking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "+"

# Bars per year by asset class, and the classes that trade without a volume tape.
PERIODS_PER_YEAR = {"crypto": 365, "equity": 252, "fx": 252}
DEFAULT_PERIODS_PER_YEAR = 252
CLASSES_WITHOUT_VOLUME = ("fx",)

# Query parameters whose value is a credential.
SECRET_NAMES = r"token|api[_-]?key|key|apikey|password|secret|access[_-]?token"

# Source priority for one bar, best first; unknown sources come last by name.
SOURCE_PRIORITY = ("coinbase", "kraken", "tiingo", "tiingo_fx")

# Lookback windows in days; None is the whole history.
LOOKBACKS = (("30d", 30), ("90d", 90), ("365d", 365), ("full", None))


#: A decimal number; spellings of NaN, infinity or typed literals are none.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """The finite number that a text holds, else NULL."""
    value = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(value) < F.lit(float("inf"))), value)


def mask_secrets(text: Column) -> Column:
    """Replace the value of credential-bearing ``name=value`` pairs by ``***``."""
    return F.regexp_replace(text, rf"(?i)\b({SECRET_NAMES})=[^&\s'\"]+", "$1=***")


def periods_per_year(asset_class: Column) -> Column:
    picked = F.lit(DEFAULT_PERIODS_PER_YEAR)
    for name, periods in PERIODS_PER_YEAR.items():
        picked = F.when(asset_class == name, F.lit(periods)).otherwise(picked)
    return picked


def class_has_volume(asset_class: Column) -> Column:
    return ~asset_class.isin(*CLASSES_WITHOUT_VOLUME)


def source_rank(source: Column) -> Column:
    rank = F.lit(len(SOURCE_PRIORITY) + 1)
    for place, name in enumerate(SOURCE_PRIORITY, start=1):
        rank = F.when(source == name, F.lit(place)).otherwise(rank)
    return rank


def growth(end: Column, start: Column) -> Column:
    """``end / start - 1``; NULL when the start is missing or zero."""
    return F.when(start.isNotNull() & (start != 0), end / start - 1)


def pct_gap(left: Column, right: Column) -> Column:
    """Absolute difference in percent of ``left``; NULL when ``left`` is zero."""
    return F.abs(left - right) / F.nullif(left, F.lit(0.0)) * 100


def ratio(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def compound(first: Column, second: Column) -> Column:
    return (F.lit(1) + first) * (F.lit(1) + second) - F.lit(1)


def name_parts(strategy: Column) -> Column:
    return F.split(strategy, r"\+")


def component_list(components: Column, strategy: Column) -> Column:
    """The stored list, or the parts of the name when the list is empty or missing."""
    return F.when(F.size(components) > 0, components).otherwise(name_parts(strategy))


def beats(own: Column, benchmark: Column, trades: Column) -> Column:
    """Strictly better than the benchmark and in the market at least once."""
    return (own > benchmark) & (F.coalesce(trades, F.lit(0)) > 0)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value.cast("double"), digits)


def existing(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def label_rank(label: Column) -> Column:
    """Position of a lookback label, shortest first."""
    return F.array_position(F.array(*[F.lit(name) for name, _ in LOOKBACKS]), label)


def best_label(excess: Column, name: Column) -> Column:
    """``+1.23% (name)``, or ``n/a`` when nothing was measured."""
    return F.when(excess.isNull(), F.lit("n/a")).otherwise(
        F.format_string("%+.2f%% (%s)", excess * 100, name)
    )


def numeric_frame(df: DataFrame, keep: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """Cast every column but ``keep`` to double, so an all-NULL column stays typed."""
    return df.select(
        *[F.col(c) if c in keep else F.col(c).cast("double").alias(c) for c in df.columns]
    )


def as_json(*columns: Column | str) -> Column:
    """Compact JSON of a struct: NULLs kept, timestamps ISO-8601 with offset and any fraction."""
    text = F.to_json(
        F.struct(*columns),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"},
    )
    return F.regexp_replace(text, r'("\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)\.000000([+-]\d\d:\d\d")', "$1$2")
