"""JSON publishing: documents per asset, an index in sections, a size report, whole curves as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import as_json, half_even
from tickloom.functions.series import evenly_spaced
from tickloom.plans.marts import recent_attempts, split_overall

# Fixed value: index size in bytes above which the size report warns.
INDEX_BYTE_BUDGET = 600_000

@dataclass(frozen=True)
class Field:
    """A published figure: other spellings it is accepted under, and what it follows from else."""

    name: str
    kind: str = "double"
    also: tuple[str, ...] = ()
    otherwise: str | None = None
    digits: int | None = None
    shown: bool = True


_NAME = Field("strategy", "string")
_SIZE = Field("n_components", "int", otherwise="size(split(strategy, '[+]'))")
_FULL = "coalesce(excess_return, total_return - buy_hold_return)"
_HELD_OUT = "coalesce(oos_excess_return, oos_total_return - oos_buy_hold_return)"
#: A variant as published, in this order. Flags that follow from an excess have no trade guard.
VARIANT = (
    _NAME,
    _SIZE,
    Field("exposure", digits=6),
    Field("total_return", also=("full_total_return",), digits=6),
    Field("buy_hold_return", also=("full_buy_hold_return",), digits=6),
    Field("excess_return", also=("full_excess_return",), otherwise=_FULL, digits=6),
    Field("is_excess_return", otherwise="is_total_return - is_buy_hold_return", digits=6),
    Field("oos_excess_return", otherwise=_HELD_OUT, digits=6),
    Field("beat_bh_full", "boolean", ("beat_buy_hold",), f"{_FULL} > 0"),
    Field("beat_bh_oos", "boolean", otherwise=f"{_HELD_OUT} > 0"),
    Field("sharpe", also=("full_sharpe",), digits=4),
    Field("max_drawdown", also=("full_max_drawdown",), digits=6),
    Field("n_trades", "int", ("full_n_trades",)),
    *[Field(f"{w}_{side}_return", also=(f"full_{w}_{side}_return",), shown=False)
      for w in ("is", "oos") for side in ("total", "buy_hold")],
)
#: A single strategy's headline figures, in the order they are published.
HEADLINE = (
    _NAME,
    *[Field(c) for c in ("total_return", "buy_hold_return")],
    Field("excess_return", otherwise="total_return - buy_hold_return"),
    *[Field(c) for c in ("max_drawdown", "sharpe")],
    Field("n_trades", "bigint"),
    Field("win_rate"),
)


def published(rows: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """``keep`` and the shown fields of any table that holds them under an accepted spelling.

    A field without one is worked out, else NULL; spellings are tried in order for every row.
    """
    def found(field: Field) -> Column:
        names = [x for x in (field.name, *field.also) if x in rows.columns]
        return F.coalesce(F.lit(None).cast(field.kind), *[F.col(x).cast(field.kind) for x in names])

    def final(field: Field) -> Column:
        value = F.col(field.name)
        if field.otherwise is not None:
            value = F.coalesce(value, F.expr(field.otherwise).cast(field.kind))
        return (value if field.digits is None else half_even(value, field.digits)).alias(field.name)

    named = rows.select(*keep, *[found(f).alias(f.name) for f in fields])
    return named.select(*keep, *[final(f) for f in fields if f.shown])


def variant_entries(rows: DataFrame) -> DataFrame:
    """Published shape of variants, from the variant mart or from plain runs."""
    return published(rows, VARIANT)


def top_variants(entries: DataFrame, limit: int) -> DataFrame:
    """Best ``limit`` variants per asset by out-of-sample excess; unscored ones come last."""
    w = Window.partitionBy("symbol").orderBy(
        F.col("oos_excess_return").desc_nulls_last(), "n_components", "strategy"
    )
    return entries.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def grouped_entries(entries: DataFrame) -> DataFrame:
    """Variants of each asset as one array ordered by size and name, with their true number.

    An asset has at most ``2**k - 1`` variants, so the array is bounded by the configuration.
    """
    item = F.struct(
        F.col("n_components").alias("_n"),
        F.col("strategy").alias("_s"),
        F.struct(*[f.name for f in VARIANT if f.shown]).alias("entry"),
    )
    grouped = entries.groupBy("symbol").agg(
        F.array_sort(F.collect_list(item)).alias("_items"),
        F.count(F.lit(1)).alias("n_combinations"),
    )
    return grouped.select(
        "symbol",
        "n_combinations",
        F.transform("_items", lambda x: x["entry"]).alias("combinations"),
    )


def asset_documents(
    catalog: DataFrame,
    generated_at: Column,
    *,
    summary: DataFrame | None = None,
    quality: DataFrame | None = None,
    reconciliation: DataFrame | None = None,
    runs: DataFrame | None = None,
    variants: DataFrame | None = None,
) -> DataFrame:
    """One index document per configured asset (JSON lines, so no task holds the whole index).

    An asset a mart has no row for gets NULL or an empty list there, and so does every asset where
    the mart is absent. Variants come from their mart, or from the latest runs where it is absent.
    """
    out = catalog.select("symbol", "name", "asset_class", "region", "fx_pair")
    marts = {"summary": summary, "data_quality": quality, "reconciliation": reconciliation}
    for name, mart in marts.items():
        if mart is None:
            out = out.withColumn(name, F.lit(None).cast("string"))
        else:
            row = mart.select("symbol", F.struct(*mart.columns).alias(name))
            out = out.join(row, "symbol", "left")

    lists = {"strategies": F.array(), "combinations": F.array(), "n_combinations": F.lit(0)}
    if runs is not None:
        single = F.coalesce(F.col("strategy_kind"), F.lit("single")) == "single"
        figures = published(runs.where(single), HEADLINE)
        listed = F.array_sort(F.collect_list(F.struct(*[f.name for f in HEADLINE])))
        out = out.join(figures.groupBy("symbol").agg(listed.alias("strategies")), "symbol", "left")
        lists["strategies"] = F.coalesce("strategies", F.array())
    entries = variants if variants is not None else runs
    if entries is not None:
        out = out.join(grouped_entries(variant_entries(entries)), "symbol", "left")
        lists["combinations"] = F.coalesce("combinations", F.array())
        lists["n_combinations"] = F.coalesce("n_combinations", F.lit(0))
    document = as_json(
        generated_at.alias("generated_at"), "symbol", "name", "asset_class", "region", "fx_pair",
        *marts, *[value.alias(name) for name, value in lists.items()],
    )
    return out.select("symbol", document.alias("document"))


#: How the index says that every variant is listed, and by what they are ranked.
COMBINATIONS_INDEX = {"mode": "full", "limit_per_asset": None, "ranked_by": "oos_excess_return"}
RECENT_RUNS = 40
SECTION = "section string, key string, document string"


def index_sections(
    catalog: DataFrame,
    generated_at: Column,
    *,
    overfitting: DataFrame | None = None,
    leaderboard: DataFrame | None = None,
    fx_decomposition: DataFrame | None = None,
    totals: DataFrame | None = None,
    recent_ingest_runs: DataFrame | None = None,
    **assets: DataFrame | None,
) -> DataFrame:
    """The whole index as rows (section, key, document), one dataset to be written by section.

    The pooled row of ``overfitting`` and the only row of ``totals`` have an empty key. Each section is the JSON rows of its mart: they are small beside the assets, but none is put
    into one document. An absent mart leaves its section without rows; the section ``contents`` says
    for each section whether its mart was there.
    """
    def rows(section: str, df: DataFrame | None, *key: str) -> DataFrame | None:
        if df is None:
            return None
        return df.select(
            F.lit(section).alias("section"), F.concat_ws("/", *key).alias("key"),
            as_json(*df.columns).alias("document"),
        )

    parts = {
        "fx_decomposition": rows("fx_decomposition", fx_decomposition, "symbol", "window_label"),
        "leaderboard": rows("leaderboard", leaderboard, "strategy", "asset_class", "region"),
        "totals": rows("totals", totals),
        "overfitting": None,
        "recent_ingest_runs": None,
    }
    if overfitting is not None:
        by_size, overall = split_overall(overfitting)
        detail = rows("overfitting", by_size, "n_components")
        parts["overfitting"] = detail.unionByName(rows("overfitting", overall))
    if recent_ingest_runs is not None:
        recent = recent_attempts(recent_ingest_runs, RECENT_RUNS)
        parts["recent_ingest_runs"] = rows("recent_ingest_runs", recent, "source", "symbol")
    documents = asset_documents(catalog, generated_at, **assets).select(
        F.lit("assets").alias("section"), F.col("symbol").alias("key"), "document"
    )
    how = F.struct(*[F.lit(v).cast("string").alias(k) for k, v in COMBINATIONS_INDEX.items()])
    spark = catalog.sparkSession
    one = spark.range(1)
    whole = documents.unionByName(
        one.select(
            F.lit("combinations_index").alias("section"), F.lit("how").alias("key"),
            F.to_json(how, {"ignoreNullFields": "false"}).alias("document"),
        )
    )
    present = [("assets", True), ("combinations_index", True)]
    for section, part in parts.items():
        present.append((section, part is not None))
        if part is not None:
            whole = whole.unionByName(part)
    contents = spark.createDataFrame(present, "key string, present boolean").select(
        F.lit("contents").alias("section"), "key",
        as_json(generated_at.alias("generated_at"), F.col("key").alias("section"), "present").alias("document"),
    )
    return whole.unionByName(contents)


def index_size_report(documents: DataFrame, budget: int = INDEX_BYTE_BUDGET) -> DataFrame:
    """index_bytes, documents, listed (variants), budget and severity (``warn`` above the budget).

    One distributed sum; the index itself is the same at every size.
    """
    variants = F.json_array_length(F.get_json_object("document", "$.combinations"))
    sized = documents.agg(
        F.coalesce(F.sum(F.octet_length("document")), F.lit(0)).alias("index_bytes"),
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(variants), F.lit(0)).alias("listed"),
    ).withColumn("budget", F.lit(budget))
    return sized.withColumn(
        "severity", F.when(F.col("index_bytes") > F.col("budget"), "warn").otherwise("ok")
    )


def thin_curves(curves: DataFrame, limit: int) -> DataFrame:
    """Keep at most ``limit`` evenly spaced points per curve; needs ``rn`` and ``n``."""
    return curves.where(evenly_spaced(F.col("rn"), F.col("n"), limit)).withColumns(
        {c: half_even(F.col(c), 2) for c in ("equity", "buy_hold_equity")}
    )


def split_boundary(runs: DataFrame) -> DataFrame:
    """First known split per asset, in strategy-name order."""
    return runs.groupBy("symbol").agg(
        F.min_by("split_ts", F.when(F.col("split_ts").isNotNull(), F.col("strategy"))).alias(
            "split_ts"
        )
    )


def symbol_documents(
    catalog: DataFrame,
    runs: DataFrame,
    curves: DataFrame,
    entries: DataFrame,
    generated_at: Column,
) -> DataFrame:
    """One full-detail document per asset with runs. Curves are counted here, not embedded: they
    grow with the history and are written whole by ``write_curves``."""
    counted = curves.groupBy("symbol", "strategy").agg(F.count(F.lit(1)).alias("curve_points"))
    singles = runs.where("strategy_kind = 'single'").join(counted, ["symbol", "strategy"], "left")
    metrics = F.struct(
        "total_return", "cagr", "buy_hold_return", "max_drawdown", "sharpe", "win_rate",
        (F.col("total_return") - F.col("buy_hold_return")).alias("excess_return"),
        "n_trades", "n_bars",
    )
    item = F.struct(
        "strategy",
        "params",
        metrics.alias("metrics"),
        F.coalesce("curve_points", F.lit(0)).alias("curve_points"),
    )
    tests = singles.groupBy("symbol").agg(F.array_sort(F.collect_list(item)).alias("backtests"))
    return (
        catalog.join(split_boundary(runs), "symbol")
        .join(tests, "symbol", "left")
        .join(grouped_entries(entries), "symbol", "left")
        .select(
            "symbol",
            as_json(
                "symbol", "name", "asset_class", "region",
                generated_at.alias("generated_at"),
                "split_ts",
                F.coalesce("backtests", F.array()).alias("backtests"),
                F.coalesce("combinations", F.array()).alias("combinations"),
            ).alias("document"),
        )
    )


def write_index(sections: DataFrame, path: str) -> None:
    """JSON lines in one folder per section; the next writing replaces all of them."""
    sections.select("section", F.col("document").alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("section").text(path)


def write_curves(curves: DataFrame, path: str) -> None:
    """Every point of every curve, one folder per symbol, files by year of a strategy."""
    curves.select(
        "symbol", "strategy", "ts",
        *[half_even(F.col(c), 2).alias(c) for c in ("equity", "buy_hold_equity")],
    ).repartition("symbol", "strategy", F.year("ts")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("symbol").parquet(path)


def write_symbols(documents: DataFrame, path: str) -> None:
    """One partition folder per symbol; a full overwrite drops symbols no longer written."""
    documents.select("symbol", F.col("document").alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("symbol").text(path)
