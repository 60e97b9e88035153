import datetime as dt
import json

from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.plans import silver
from tickloom.sources import bronze, feeds, store, tables
from tickloom.sources.catalog import catalog_from_config, read_catalog, restrict
from tickloom.streaming.ingest import ingest_new_files

DAY = dt.datetime(2024, 1, 1)
T0 = 1704067200


def responses(spark, *items):
    return spark.createDataFrame(
        [(s, p, json.dumps(r)) for s, p, r in items], "symbol string, page int, response string"
    )


def test_positional_candles(spark):
    page = [[T0, 1, 4, 2, 3, 10.5], [T0 + 86400, 2, 5, 3, 4, 0]]
    rows = feeds.coinbase_bars(responses(spark, ("BTC-USD", 0, page)))[0].orderBy("ts").collect()
    assert [(r.open, r.high, r.low, r.close, r.volume) for r in rows] == [
        (2, 4, 1, 3, 10.5), (3, 5, 2, 4, 0)]
    assert rows[0].ts == DAY and json.loads(rows[0].payload)["time"] == T0


def test_venue_response_and_rejects(spark):
    candle = [T0, "1.5", "2", "1", "1.75", "1.6", "12.25", 7]
    ok = {"error": [], "result": {"XXBTZUSD": [candle], "last": T0}}
    bars, rejects = feeds.kraken_bars(responses(
        spark, ("BTC-USD", 0, ok), ("ETH-USD", 0, {"error": ["EQuery:Unknown"]}),
        ("ETH-USD", 1, {"error": [], "result": {"last": 1}})))
    row = bars.first()
    assert (row.open, row.close, row.volume) == (1.5, 1.75, 12.25)
    payload = json.loads(row.payload)
    assert payload["close"] == "1.75" and payload["count"] == 7
    assert sorted(r.reason for r in rejects.collect()) == [
        "no candle list", "venue error: EQuery:Unknown"]


def test_dated_feeds(spark):
    equity = [{"date": "2024-01-02T00:00:00.000Z", "open": 1, "high": 3, "low": 1, "close": 2,
               "volume": 9, "adjClose": 1.9}]
    fx = [{"date": "2024-01-02T00:00:00.000Z", "ticker": "usdcop", "open": 1, "high": 3, "low": 1,
           "close": 2}]
    row = feeds.equity_bars(responses(spark, ("SPY", 0, equity)))[0].first()
    assert row.ts == dt.datetime(2024, 1, 2) and row.volume == 9
    assert feeds.fx_bars(responses(spark, ("USDCOP", 0, fx)))[0].first().volume is None
    mapped, unknown = feeds.map_symbols(
        spark.createDataFrame([("BTC-USD",), ("SPY",)], "symbol string"))
    assert mapped.first().pair == "XBTUSD" and unknown.first().symbol == "SPY"


def texts(spark, *items):
    return spark.createDataFrame(
        [("A", i, x) for i, x in enumerate(items)], "symbol string, page int, response string")


def reasons(rejects):
    return [(r.page, r.reason) for r in rejects.orderBy("page", "reason").collect()]


def test_no_candle_vanishes_and_none_stops_the_others(spark):
    good = "[1704067200,1,4,2,3,null]"
    bars, rejects = feeds.coinbase_bars(texts(
        spark, f"[{good}]", '{"message":"rate limit"}', None, f"[{good},[17040", "[]", "null",
        f"[[1704067200],{good}]", f'[["soon",1,4,2,3,5],[1e300,1,4,2,3,5],{good}]',
        f'[[1704067200,"low",4,2,3,5],null,{good}]'))
    assert sorted(r.page for r in bars.collect()) == [0, 6, 7, 8]
    assert bars.where("volume is not null").count() == 0
    assert reasons(rejects) == [
        (1, "no candle list"), (2, "no candle list"), (3, "no candle list"), (5, "no candle list"),
        (6, "incomplete candle"), (7, "unreadable time"), (7, "unreadable time"),
        (8, "incomplete candle"), (8, "unreadable number")]
    audit = bronze.rejected_rows(rejects, F.lit(DAY)).collect()
    assert {(r.error, r.rows_fetched) for r in audit} == {
        ("no candle list", 4), ("incomplete candle", 2), ("unreadable time", 2),
        ("unreadable number", 1)}


def test_dated_rows_keep_their_own_text(spark):
    item = ('{"date":"2024-01-02T00:00:00.000Z","open":"1.5","high":3,"low":null,"close":2,'
            '"volume":123456789012,"venue":{"id":7}}')
    late = item.replace("2024-01-02T00:00:00.000Z", "soon")
    page = f'[{item},{late},{{"message":"x"}},{item.replace("3,", chr(34) + "high" + chr(34) + ",")}]'
    for parse in (feeds.equity_bars, feeds.fx_bars):
        bars, rejects = parse(texts(spark, page, '{"message":"rate limit"}', page[:-9], "[]"))
        row, = bars.collect()
        assert (row.payload, row.open, row.low, row.close) == (item, 1.5, None, 2)
        assert reasons(rejects) == [
            (0, "incomplete candle"), (0, "unreadable number"), (0, "unreadable time"),
            (1, "no candle list"), (2, "no candle list")]


def test_pages_are_closed_and_disjoint(spark):
    spans = spark.createDataFrame(
        [("A", DAY, DAY + dt.timedelta(days=700)), ("B", DAY, DAY),
         ("C", DAY, DAY - dt.timedelta(days=1))],
        "symbol string, window_start timestamp, window_end timestamp")
    rows = feeds.page_windows(spans).orderBy("symbol", "page_start").collect()
    assert [(r.symbol, (r.page_end - r.page_start).days) for r in rows] == [
        ("A", 299), ("A", 299), ("A", 100), ("B", 0)]
    assert rows[1].page_start - rows[0].page_end == dt.timedelta(days=1)


def test_later_page_wins_inside_the_window(spark):
    first = [[T0, 1, 1, 1, 1, 1], [T0 + 86400, 1, 1, 1, 1, 1]]
    second = [[T0 + 86400, 1, 1, 1, 2, 1], [T0 + 2 * 86400, 1, 1, 1, 3, 1]]
    bars, _ = feeds.coinbase_bars(responses(spark, ("A", 0, first), ("A", 1, second)))
    rows = feeds.clip_window(bars, F.lit(DAY), F.lit(DAY + dt.timedelta(days=1))).orderBy("ts")
    assert [r.close for r in rows.collect()] == [1, 2]


def candle(symbol, day, payload="{}", source="coinbase"):
    return (source, symbol, "1d", DAY + dt.timedelta(days=day), payload)


CANDLE = "source string, symbol string, granularity string, candle_ts timestamp, payload string"


def test_append_is_idempotent(spark):
    stored = spark.createDataFrame([candle("A", 0)], CANDLE)
    incoming = spark.createDataFrame(
        [(*candle("A", 0, "x"), 1), (*candle("A", 1, "old"), 1), (*candle("A", 1, "new"), 2)],
        CANDLE + ", arrival int")
    fresh = bronze.unseen(incoming, stored, first_by="arrival").drop("arrival")
    assert [(r.payload) for r in fresh.collect()] == ["old"]
    again = bronze.unseen(incoming, stored.unionByName(fresh), first_by="arrival")
    assert again.isEmpty()


def test_fetch_windows_and_marks(spark):
    stored = spark.createDataFrame([candle("A", 0), candle("A", 5), candle("B", 9)], CANDLE)
    wanted = spark.createDataFrame(
        [("coinbase", s, "1d", DAY - dt.timedelta(days=30)) for s in "ABC"],
        "source string, symbol string, granularity string, backfill_start timestamp")
    now = F.lit(DAY + dt.timedelta(days=10, hours=13))
    rows = {r.symbol: r for r in bronze.fetch_windows(
        wanted, bronze.high_water_marks(stored), now).collect()}
    assert rows["A"].window_start == DAY + dt.timedelta(days=6)
    assert rows["A"].window_end == DAY + dt.timedelta(days=9)
    assert rows["B"].is_empty and rows["C"].window_start == DAY - dt.timedelta(days=30)


def test_outcomes(spark):
    schema = "status string, rate_limited boolean, auth_failed boolean"

    def publishable(*rows):
        return bronze.run_outcome(spark.createDataFrame(list(rows), schema)).first().publishable

    assert publishable(("success", False, False), ("failed", False, False))
    assert publishable(("failed", True, False))
    assert not publishable(("failed", False, False))
    assert not publishable(("success", False, False), ("failed", False, True))


def test_masking(spark):
    text = "GET https://x?token=abc&n=1 API-KEY=zz 'password=p' mytoken=keep secret=s\"q"
    row = spark.createDataFrame([(text,)], "t string").select(
        scalars.mask_secrets(F.col("t")).alias("m")).first()
    assert row.m == ("GET https://x?token=***&n=1 API-KEY=*** 'password=***' mytoken=keep "
                     "secret=***\"q")


def test_typing_and_priority(spark):
    rows = [
        candle("A", 0, '{"open":"1","high":"3","low":"1","close":"2.5","volume":"0"}', "kraken"),
        candle("A", 0, '{"open":1,"high":3,"low":1,"close":2,"volume":4}', "coinbase"),
        candle("A", 1, '{"open":1,"high":1,"low":2,"close":2,"adjClose":1.5}', "tiingo"),
        candle("A", 2, '{"open":1,"close":2}', "zeta"),
        candle("A", 2, '{"open":7,"close":2}', "alpha"),
    ]
    typed = silver.all_sources(spark.createDataFrame(rows, CANDLE))
    by = {(r.source, r.ts.day): r for r in typed.collect()}
    assert by["kraken", 1].close == 2.5 and by["kraken", 1].is_zero_volume
    assert by["tiingo", 2].adj_close == 1.5 and by["tiingo", 2].high_lt_low
    assert by["zeta", 3].has_null_price and by["zeta", 3].volume is None
    best = silver.canonical(typed).orderBy("ts").collect()
    assert [r.source for r in best] == ["coinbase", "tiingo", "alpha"]


def test_catalog(spark, tmp_path):
    config = {"assets": [
        {"symbol": "EC", "asset_class": "equity", "region": "latam", "name": "Eco",
         "fx_pair": "USDCOP"},
        {"symbol": "USDCOP", "asset_class": "fx"}]}
    catalog = catalog_from_config(spark, config)
    rows = {r.symbol: r for r in catalog.collect()}
    assert rows["USDCOP"].region == "global" and rows["USDCOP"].name == "USDCOP"
    assert not rows["USDCOP"].has_volume and rows["EC"].periods_per_year == 252
    path = tmp_path / "assets.csv"
    path.write_text("symbol,asset_class,region,name,has_volume,fx_pair\nEC,equity,latam,E,true,\n")
    row = read_catalog(spark, str(path)).first()
    assert row.fx_pair is None and row.has_volume is True
    assert restrict(catalog, catalog.where("symbol = 'EC'")).count() == 1


def test_optional_relation(spark, tmp_path):
    empty = tables.read_optional(spark, str(tmp_path / "none"), "a int, b string")
    assert empty.columns == ["a", "b"] and empty.isEmpty()
    runs = spark.createDataFrame([("A", "macd")], "symbol string, strategy string")
    assert tables.first_available(spark, str(tmp_path / "none"), runs).count() == 1
    tables.rebuild(runs.union(runs), str(tmp_path / "mart"))
    assert tables.first_available(spark, str(tmp_path / "mart"), runs).count() == 2


def test_replicate_skips_surrogates(spark):
    source = spark.createDataFrame([(*candle("A", d), d) for d in range(3)],
                                   CANDLE + ", raw_candle_id int")
    target = spark.createDataFrame([candle("A", 0)], CANDLE)
    fresh, counts = bronze.replicate(source, target, bronze.CANDLE_KEY)
    row = counts.first()
    assert "raw_candle_id" not in fresh.columns
    assert (row.rows_sent, row.rows_inserted) == (3, 2)


def test_file_arrivals_are_ingested_once(spark, tmp_path):
    landing, store, mark, audit = (
        str(tmp_path / n) for n in ("landing", "bronze", "mark", "audit"))
    page = json.dumps([[T0, 1, 1, 1, 1, 1], [T0 + 86400, 1, 1, 1, 1, 1]])

    def arrive(n):
        spark.createDataFrame([("BTC-USD", n, page), ("BTC-USD", n, '{"message":"busy"}')],
                              "symbol string, page int, response string"
                              ).coalesce(1).write.mode("append").json(landing)
        ingest_new_files(
            spark, landing, store, mark, feeds.coinbase_bars, audit).awaitTermination(60)

    arrive(0)
    arrive(1)
    assert spark.read.parquet(store).count() == 2
    rows = spark.read.parquet(audit).collect()
    assert sorted((r.batch, r.rows_fetched, r.rows_inserted, r.status) for r in rows) == [
        (0, 1, 0, "failed"), (1, 1, 0, "failed")]


def test_runs_are_appended_with_curves_of_singles_only(spark, tmp_path):
    runs = spark.createDataFrame(
        [("r1", "A", "macd", True), ("r2", "A", "fibonacci+macd", False)],
        "backtest_run_id string, symbol string, strategy string, has_curve boolean")
    curves = spark.createDataFrame(
        [("A", s, DAY, 1.0, 1.0) for s in ("macd", "fibonacci+macd")],
        "symbol string, strategy string, ts timestamp, equity double, buy_hold_equity double")
    paths = str(tmp_path / "runs"), str(tmp_path / "curves")
    tables.append_runs(runs, curves, *paths)
    tables.append_runs(runs, curves, *paths)
    assert spark.read.parquet(paths[0]).count() == 4
    assert {r.backtest_run_id for r in spark.read.parquet(paths[1]).collect()} == {"r1"}


def test_feed_files_are_read_with_a_fixed_schema(spark, tmp_path):
    page = json.dumps([[T0, 1, 1, 1, 1, 1]])
    path = str(tmp_path / "responses")
    spark.createDataFrame([("A", 0, page)], "symbol string, page int, response string"
                          ).write.json(path)
    assert feeds.coinbase_bars(feeds.read_responses(spark, path))[0].count() == 1


def candles(spark, *rows):
    return spark.createDataFrame(
        [("coinbase", "A", "1d", DAY.replace(month=m, day=d), p, a) for m, d, p, a in rows],
        "source string, symbol string, granularity string, candle_ts timestamp, payload string, arrival int")


def test_append_reads_only_the_months_it_touches(spark, tmp_path):
    path = str(tmp_path / "candles")
    first = candles(spark, (1, 1, "a", 1), (2, 1, "b", 1), (3, 1, "c", 1))
    assert store.append_candles(spark, first, path, first_by="arrival").inserted.count() == 3
    again = candles(spark, (2, 1, "other", 1), (2, 2, "late", 2), (2, 2, "early", 1))
    done = store.append_candles(spark, again, path, first_by="arrival")
    assert [tuple(r) for r in done.by_month().collect()] == [("coinbase", "2024-02", 3, 1)]
    stored = store.read_store(spark, path)
    assert {(r.candle_ts.month, r.payload) for r in stored.collect()} == {
        (1, "a"), (2, "b"), (2, "early"), (3, "c")}
    # offering all of it again inserts nothing
    once_more = first.unionByName(again)
    assert store.append_candles(spark, once_more, path, first_by="arrival").inserted.count() == 0

    part = store.touched(stored, store.with_month(again))
    scan = part._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    filters = scan.partitionFilters().mkString(" ")
    assert "2024-02" in filters and "2024-01" not in filters and "2024-03" not in filters
    assert store.already_stored(stored, store.with_month(again)).count() == 2


def test_payload_is_the_element_as_received(spark):
    own = ['{"date":"2024-01-02T00:00:00Z", "open":1.10,"high":123456789012.123456789,"low":1,"close":1e0 }',
           '{"date":"2024-01-03T00:00:00Z","open":1,"high":1,"low":1,"close":1,"note":"a ]},[\\"{","x":[1,{"y":2.50}]}']
    text = f" [ {own[0]} ,\n{own[1]}] "
    for parse in (feeds.equity_bars, feeds.fx_bars):
        bars, rejects = parse(texts(spark, text, "[]", "[ ]", f"[{own[0]}", f"[{own[0]}]]"))
        assert [r.payload for r in bars.where("page = 0").orderBy("ts").collect()] == own
        assert [r.page for r in rejects.collect()][:1] == [3]
    assert feeds.element_texts('["a\\"],[b",{"c":"}"}]') == ['"a\\"],[b"', '{"c":"}"}']
    assert feeds.element_texts("[1, [2,3] ,null]") == ["1", "[2,3]", "null"]
    assert feeds.element_texts("{}") is None and feeds.element_texts(None) is None
    assert feeds.element_texts("[]") == [] and feeds.element_texts("[1]x") is None


def test_no_number_is_a_reject_in_every_feed(spark):
    for word in ('"NaN"', "NaN", '"Infinity"', '"-Infinity"', '"1d"', '"0x1p3"', "1e999", '"1_0"'):
        listed = f"[[1704067200,1,4,{word},3,5],[1704153600,1,4,2,3,5]]"
        dated = (f'[{{"date":"2024-01-02","open":{word},"high":1,"low":1,"close":1}},'
                 '{"date":"2024-01-03","open":"1.5","high":1,"low":1,"close":1}]')
        venue = f'{{"error":[],"result":{{"P":[[1704067200,{word},"1","1","1","1","1",2]],"last":1}}}}'
        for parse, text, good in ((feeds.coinbase_bars, listed, 1), (feeds.equity_bars, dated, 1),
                                  (feeds.fx_bars, dated, 1), (feeds.kraken_bars, venue, 0)):
            bars, rejects = parse(texts(spark, text))
            assert (bars.count(), reasons(rejects)) == (good, [(0, "unreadable number")]), (word, parse)


def test_payloads_are_parsed_once(spark):
    raw = candles(spark, (1, 1, '{"open":"1.5","high":2,"low":1,"close":"NaN","volume":0}', 1))
    typed = silver.all_sources(raw)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
    row = typed.first()
    assert (row.open, row.close, row.is_zero_volume, row.has_null_price) == (1.5, None, True, True)
