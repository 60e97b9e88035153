import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.walk import DAY0, bars, frame
from tickloom.functions import scalars
from tickloom.operators import expectations as q
from tickloom.operators.retention import backfill_components, cascade, pruned_count, retain
from tickloom.plans import marts, measures
from tickloom.sources import json_sinks as sinks

CATALOG = ("symbol string, asset_class string, region string, name string, has_volume boolean, "
           "fx_pair string")


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [("A", "equity", "latam", "a", True, "FX"), ("FX", "fx", "latam", "f", False, None),
         ("C", "crypto", "global", "c", True, None)], CATALOG)


def test_fx_identity_and_missing_leg(spark, catalog):
    up = [100 * 1.01**i for i in range(40)]
    down = [50 * 0.99**i for i in range(20)]
    mart = marts.fx_decomposition(frame(spark, bars(up, "A"), bars(down, "FX")), catalog)
    rows = {r.window_label: r for r in mart.collect()}
    assert set(rows) == {"30d", "90d", "365d", "full"}
    full = rows["full"]
    assert full.usd_return == pytest.approx(1.01**39 - 1)
    assert (1 + full.local_return) == pytest.approx(1.01**39 * 0.99**19)
    assert full.fx_drag_pp == pytest.approx(full.usd_return - full.local_return)
    assert rows["30d"].usd_return == pytest.approx(1.01**30 - 1)
    assert rows["30d"].fx_return is None and rows["30d"].local_return is None
    assert rows["90d"].adr_start_ts is None and rows["90d"].adr_end_ts is not None
    assert q.row_rules(mart, "fx", {"identity": q.fx_identity_broken()}).first().n_failed == 0


def test_quality_calendars(spark, catalog):
    df = frame(spark, bars([1.0] * 5, "A", step=2), bars([1.0] * 5, "C", step=2)).withColumns(
        {"has_null_price": F.lit(False), "is_zero_volume": F.lit(True)})
    rows = {r.symbol: r for r in marts.data_quality(df, catalog).collect()}
    assert rows["C"].expected_days == 9 and rows["C"].missing_days == 4
    weekdays = sum((DAY0 + dt.timedelta(days=i)).weekday() < 5 for i in range(9))
    assert rows["A"].expected_days == weekdays
    assert rows["A"].max_gap_days == 2 and rows["A"].n_zero_volume == 5
    single = df.where(F.col("ts") == F.lit(DAY0)).where("symbol = 'C'")
    assert marts.data_quality(single, catalog).first().max_gap_days == 0


def test_reconciliation_edges(spark):
    rows = [("coinbase", "A", DAY0, 100.0), ("kraken", "A", DAY0, 100.6),
            ("coinbase", "B", DAY0, 0.0), ("kraken", "B", DAY0, 1.0),
            ("coinbase", "C", DAY0, 1.0)]
    typed = spark.createDataFrame(rows, "source string, symbol string, ts timestamp, close double")
    got = {r.symbol: r for r in marts.source_reconciliation(typed).collect()}
    assert set(got) == {"A", "B"} and got["A"].is_discrepant
    assert got["B"].abs_pct_diff is None and got["B"].is_discrepant is False
    rate = marts.discrepancy_rate(marts.source_reconciliation(typed))
    assert rate.first().discrepant_rate == 0.5
    assert q.discrepancy_warning(rate).first().n_failed == 1


RUN = (
    "backtest_run_id string, executed_at timestamp, symbol string, strategy string, "
    "strategy_kind string, components array<string>, n_components int, has_curve boolean, "
    "n_bars int, split_ts timestamp, exposure double, total_return double, "
    "buy_hold_return double, sharpe double, max_drawdown double, n_trades int, "
    "is_total_return double, is_buy_hold_return double, is_sharpe double, "
    "is_max_drawdown double, is_n_trades int, is_exposure double, oos_total_return double, "
    "oos_buy_hold_return double, oos_sharpe double, oos_max_drawdown double, oos_n_trades int, "
    "oos_exposure double, params string, cagr double, win_rate double"
)


def run(run_id, day, strategy="macd", symbol="A", components=None, full=(0.2, 0.1, 3),
        ins=(0.2, 0.1, 3), oos=(0.2, 0.1, 3), sharpe=1.0):
    parts = strategy.split("+") if components is None else components
    n = strategy.count("+") + 1

    def window(w):
        return (w[0], w[1], sharpe, -0.1, w[2], 0.5) if w else (None,) * 6

    i, o = window(ins), window(oos)
    return (run_id, DAY0 + dt.timedelta(days=day), symbol, strategy,
            "single" if n == 1 else "combo", parts, n, n == 1, 100, DAY0, 0.5, full[0], full[1],
            sharpe, -0.1, full[2], *i, *o, "{}", 0.1, 0.5)


def runs(spark, *rows):
    return spark.createDataFrame(list(rows), RUN)


def test_variant_mart(spark, catalog):
    df = runs(
        spark,
        run("old", 0, full=(9.0, 0.0, 1)), run("new", 1),
        run("none", 0, "fibonacci", ins=None, oos=None, full=(0.0, -0.2, 0)),
        run("legacy", 0, "fibonacci+macd", components=[]),
        run("lost", 0, symbol="ZZ"),
    )
    rows = {r.strategy: r for r in marts.combination_analysis(df, catalog).collect()}
    assert set(rows) == {"macd", "fibonacci", "fibonacci+macd"}
    assert rows["macd"].total_return == 0.2 and rows["macd"].beat_bh_oos
    assert rows["fibonacci"].beat_bh_full is False
    assert rows["fibonacci"].beat_bh_is is False and rows["fibonacci"].is_excess_return is None
    assert rows["fibonacci+macd"].components == ["fibonacci", "macd"]


def test_summary_marts_agree_on_one_population(spark, catalog):
    df = runs(
        spark,
        run("1", 0, "macd", "A", sharpe=1.0), run("2", 0, "macd", "FX", oos=(0.0, 0.1, 2),
                                                  sharpe=3.0),
        run("3", 0, "macd", "C", oos=None, sharpe=8.0),
        run("4", 0, "fibonacci+macd", "A", ins=(0.0, 0.1, 1), oos=None),
    )
    variants = marts.combination_analysis(df, catalog)
    board = {(r.strategy, r.asset_class): r for r in marts.strategy_leaderboard(variants).collect()}
    total = board["macd", "ALL"]
    assert (total.n_backtests, total.n_beat_is, total.n_beat_is_scored_oos) == (3, 3, 2)
    assert total.oos_survival_rate == 0.5 and total.median_sharpe == 3.0
    assert board["macd", "equity"].median_sharpe == 1.0 and len(board) == 6
    assert board["fibonacci+macd", "ALL"].oos_survival_rate is None
    summary = {r.n_components: r for r in marts.overfitting_summary(variants).collect()}
    assert summary[None].is_grand_total and summary[None].n_variants == 4
    assert summary[1].n_evaluated_both == 2 and summary[2].share_beat_oos is None
    shown = measures.variant_report(variants, ["n_components"], ["oos_survival"])
    bi = {r.n_components: r.oos_survival for r in shown.collect()}
    assert bi[1] == pytest.approx(1 / 3) and bi[2] is None
    assert q.survival_violations(
        marts.strategy_leaderboard(variants), marts.overfitting_summary(variants)).isEmpty()


def test_retention_keeps_per_variant(spark):
    df = runs(spark, *[run(f"{s}{d}", d, s) for s in ("macd", "fibonacci") for d in range(4)],
              run("solo", 0, "macd", "C"))
    kept = retain(df, 2)
    assert {r.backtest_run_id for r in kept.collect()} == {
        "macd2", "macd3", "fibonacci2", "fibonacci3", "solo"}
    assert pruned_count(df, kept).first().n_pruned == 4
    curves = df.select("backtest_run_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("p"))
    assert cascade(curves, kept).count() == 10
    with pytest.raises(ValueError):
        retain(df, 0)
    fixed = backfill_components(runs(spark, run("x", 0, "a+b", components=[]))).first()
    assert fixed.components == ["a+b"] and fixed.n_components == 1


def test_input_gate(spark, catalog):
    good = bars([1.0, 2.0], "C")
    doubled = [*bars([1.0, 2.0], "A"), *bars([1.0], "A")]
    quiet = bars([1.0], "FX", volumes=[None])
    gate = {r.symbol: r for r in q.input_gate(frame(spark, good, doubled, quiet),
                                              catalog).collect()}
    assert gate["C"].passes and gate["FX"].passes
    assert gate["A"].repeated_ts == 1 and not gate["A"].passes
    df = frame(spark, good, doubled)
    assert {r.symbol for r in q.gated(df, q.input_gate(df, catalog)).collect()} == {"C"}


def test_row_rules_and_constraints(spark):
    df = runs(spark, run("1", 0, "macd+fibonacci"), run("2", 0, "macd"))
    assert q.row_rules(df, "r", {"naming": q.naming_broken()}).first().n_failed == 1
    broken = df.withColumn("has_curve", F.lit(True)).withColumn("n_components", F.lit(3))
    report = {r.expectation: r.n_failed for r in
              q.row_rules(broken, "runs", q.run_constraints()).collect()}
    assert report == {"kind_is_known": 0, "curve_only_for_singles": 1,
                      "components_match_count": 2}
    keyed = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    assert q.unique(keyed, "t", ["k", "v"]).first().n_failed == 1
    assert q.relationship(keyed, "t", "k", keyed.where("k = 'b'"), "k").first().n_failed == 1
    assert q.blocking(q.unique(keyed, "t", ["k", "v"], q.WARN)).isEmpty()


def test_index_is_whole_at_every_budget(spark, catalog):
    many = [run(f"{i}", 0, "+".join(f"s{j}" for j in range(5) if i >> j & 1), "A",
                oos=(i / 100, 0.0, 1) if i % 4 else None) for i in range(1, 32)]
    variants = marts.combination_analysis(runs(spark, *many), catalog)
    entries = sinks.variant_entries(variants)
    nothing = spark.createDataFrame([], "symbol string, x int")
    docs = sinks.asset_documents(
        catalog, F.lit(DAY0), summary=nothing, quality=nothing, runs=runs(spark, *many), variants=variants)
    wide, narrow = (sinks.index_size_report(docs, n).first() for n in (10**6, 10))
    assert (wide.severity, narrow.severity) == ("ok", "warn")
    assert wide.index_bytes == narrow.index_bytes > 10
    docs = {r.symbol: json.loads(r.document) for r in docs.collect()}
    assert len(docs) == 3
    assert len(docs["A"]["combinations"]) == docs["A"]["n_combinations"] == 31
    assert docs["C"]["summary"] is None and docs["C"]["combinations"] == []
    assert docs["A"]["generated_at"] == "2020-01-01T00:00:00+00:00"
    best = sinks.top_variants(entries, 5).orderBy("place").collect()
    assert [e.oos_excess_return for e in best] == [0.31, 0.3, 0.29, 0.27, 0.26]


def test_entries_from_runs_have_no_trade_guard(spark):
    plain = runs(spark, run("1", 0, full=(0.0, -0.2, 0))).drop("n_components")
    row = sinks.variant_entries(plain).first()
    assert row.beat_bh_full is True and row.n_components == 1
    assert row.excess_return == 0.2


def test_published_fields_take_any_accepted_spelling(spark):
    """The first spelling with a value wins per row; what has none follows from the others."""
    rows = spark.createDataFrame(
        [("A", "a+b", None, 0.5, 0.25, None, 0.1234567), ("A", "b", 0.75, 0.5, 0.25, True, None)],
        "symbol string, strategy string, total_return double, full_total_return double, "
        "full_buy_hold_return double, beat_buy_hold boolean, oos_excess_return double")
    out = {r.strategy: r for r in sinks.variant_entries(rows).collect()}
    assert [f for f in out["b"].asDict() if f != "symbol"] == [f.name for f in sinks.VARIANT if f.shown]
    assert (out["a+b"].total_return, out["a+b"].excess_return, out["a+b"].n_components) == (0.5, 0.25, 2)
    assert (out["b"].total_return, out["b"].excess_return, out["b"].beat_bh_full) == (0.75, 0.5, True)
    assert (out["a+b"].oos_excess_return, out["a+b"].beat_bh_oos) == (0.123457, True)
    assert out["b"].beat_bh_oos is None and out["b"].n_trades is None and out["b"].sharpe is None


def test_index_is_written_by_section_and_replaced_whole(spark, catalog, tmp_path):
    path = str(tmp_path / "index")
    totals = spark.createDataFrame([(3,)], "assets int")
    sinks.write_index(sinks.index_sections(catalog, F.lit(DAY0), totals=totals), path)
    stored = spark.read.text(path)
    assert {r.section for r in stored.collect()} == {"assets", "combinations_index", "contents", "totals"}
    sinks.write_index(sinks.index_sections(catalog, F.lit(DAY0)), path)
    stored = spark.read.text(path)
    by_section = {r.section: r["count"] for r in stored.groupBy("section").count().collect()}
    assert by_section == {"assets": 3, "combinations_index": 1, "contents": 7}
    contents = [json.loads(r.value) for r in stored.where("section = 'contents'").collect()]
    assert {c["section"] for c in contents if c["present"]} == {"assets", "combinations_index"}


def test_pooled_rows_are_known_by_flag_size_or_label(spark):
    flagged = spark.createDataFrame([(True, 3, "x"), (False, 1, "x"), (None, None, "x")],
                                    "is_grand_total boolean, n_components int, note string")
    detail, overall = marts.split_overall(flagged)
    assert [r.n_components for r in detail.collect()] == [1] and overall.count() == 2
    labelled = spark.createDataFrame([("1", 5), ("Overall", 9)], "size string, n int")
    detail, overall = marts.split_overall(labelled)
    assert detail.first().n == 5 and overall.first().n == 9


def test_json_keeps_fractions_of_seconds(spark):
    times = spark.createDataFrame(
        [(DAY0.replace(microsecond=250_000),), (DAY0,)], "t timestamp").select(scalars.as_json("t").alias("j"))
    assert sorted(r.j for r in times.collect()) == [
        '{"t":"2020-01-01T00:00:00+00:00"}', '{"t":"2020-01-01T00:00:00.250000+00:00"}']


def test_stale_symbol_folders_are_removed(spark, catalog, tmp_path):
    docs = catalog.select("symbol", F.lit("{}").alias("document"))
    path = str(tmp_path / "per-symbol")
    sinks.write_symbols(docs, path)
    sinks.write_symbols(docs.where("symbol <> 'C'"), path)
    assert {r.symbol for r in spark.read.text(path).collect()} == {"A", "FX"}


def test_slicers(spark, catalog):
    facts = spark.createDataFrame([("A", 1.0), ("C", 2.0)], "symbol string, x double")
    assert measures.sliced(facts, catalog, region="latam").first().x == 1.0
    assert measures.project(facts, ["x", "nope"]).columns == ["x"]
