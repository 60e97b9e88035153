"""The daily job: isolation of symbols, refusals, and generations that are seen whole."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.walk import DAY0, SCHEMA, bars, frame, wave
from tickloom.operators.accounting import Costs
from tickloom.operators.signals import configure, not_binary
from tickloom.operators.variants import lattice
from tickloom.plans.daily import NothingToPublish, Scoring, daily_run, ingest, isolated_scores
from tickloom.sources import feeds
from tickloom.sources.generations import Generations
from tickloom.sources.store import read_store

SIGNALS = configure([{"name": "sma_cross", "params": {"fast": 3, "slow": 5}}])
SCORING = Scoring(SIGNALS, lattice(SIGNALS), Costs())
CATALOG = "symbol string, name string, asset_class string, region string, has_volume boolean, fx_pair string"


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(s, s, "equity", "us", True, None) for s in "ABCD"], CATALOG)


def test_one_bad_symbol_costs_one_symbol(spark, catalog):
    closes = wave(120)
    zero = list(closes)
    zero[60] = 0.0
    rows = bars(closes, "A") + bars(zero, "B") + bars(closes, "C") + bars(closes, "D")
    rows += [rows[250]]
    assert rows[250][0] == "C"
    runs, curves, quarantine = isolated_scores(
        spark.createDataFrame(rows, SCHEMA), catalog, SCORING, F.lit(DAY0)
    )
    assert {r.symbol for r in runs.collect()} == {"A", "D"}
    assert curves.select("backtest_run_id").distinct().count() == 2 and curves.count() == 240
    held = {(r.symbol, r.reason): r.n_bars for r in quarantine.collect()}
    assert held == {("B", "bad_price"): 1, ("C", "repeated_ts"): 1}


def test_signals_that_are_no_positions_are_found(spark):
    df = frame(spark, bars([1, 2, 3], "A"), bars([1, 1, 1], "B"))
    flagged = df.withColumn("sig_sma_cross", F.when(F.col("close") < 3, F.col("close").cast("int") - 1))
    found = {r.symbol: (r.n_bars, r.signals) for r in not_binary(flagged, SIGNALS).collect()}
    assert found == {"A": (1, ["sma_cross"])}


def page(spark, closes, first=0):
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp())
    rows = [[start + 86400 * i, c - 1, c + 1, c, c, 5.0] for i, c in enumerate(closes, first)]
    return spark.createDataFrame([("A", 0, json.dumps(rows))], "symbol string, page int, response string")


def now(day):
    return F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days=day)).cast("timestamp")


def test_refused_credentials_publish_nothing(spark, catalog, tmp_path):
    root = str(tmp_path / "refused")
    attempts = spark.createDataFrame(
        [("tiingo", "A", "1d", "HTTPError: 403 token=abc", True, False)],
        "source string, symbol string, granularity string, error string, auth_failed boolean, "
        "rate_limited boolean",
    )
    coinbase = {"coinbase": (feeds.coinbase_bars, page(spark, wave(10)))}
    with pytest.raises(NothingToPublish, match="1 refused"):
        daily_run(spark, root, coinbase, catalog, SCORING, now(10), now(0), attempts)
    assert Generations(spark, root).current() is None
    # raw candles are kept all the same
    assert read_store(spark, f"{root}/candles").count() == 10


def test_ingestion_goes_on_where_the_store_ends(spark, tmp_path):
    store = str(tmp_path / "candles")
    closes = wave(12)
    counts = []
    for day, upto in ((5, 8), (5, 8), (9, 12)):
        coinbase = {"coinbase": (feeds.coinbase_bars, page(spark, closes[:upto]))}
        audit = ingest(spark, store, coinbase, now(day), now(0)).first()
        counts.append((audit.status, audit.rows_fetched, audit.rows_inserted))
    # closed days only; the second offer of a day is outside its window
    assert counts == [("success", 5, 5), ("success", 0, 0), ("success", 4, 4)]
    assert read_store(spark, store).count() == 9


def test_a_reader_sees_one_generation(spark, tmp_path):
    generations = Generations(spark, str(tmp_path / "layers"))
    first = generations.begin()
    first.put("a", spark.range(3))
    first.put("b", spark.range(3).withColumn("k", F.col("id") % 2), by=("k",))
    first.put("absent", None)
    assert generations.current() is None
    assert first.publish(F.lit(DAY0)) == 1
    before = generations.current()

    second = generations.begin()
    second.put("a", spark.range(5))
    # half-way: layer a of the second generation is written, but nobody is told
    assert generations.current().read("a").count() == 3
    broken = generations.begin()
    broken.put("a", spark.range(99))
    second.put("b", spark.range(5).withColumn("k", F.lit(0).cast("long")), by=("k",))
    assert second.publish(F.lit(DAY0)) == 2
    assert (before.read("a").count(), before.read("b").count()) == (3, 3)
    after = generations.current()
    assert (after.number, after.read("a").count(), after.read("b").count()) == (2, 5, 5)
    assert after.read_optional("absent", "x int").count() == 0
    history = generations.history("a").groupBy("generation").count().collect()
    assert sorted(map(tuple, history)) == [(1, 3), (2, 5)]
