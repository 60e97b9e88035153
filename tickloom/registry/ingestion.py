"""Registered queries: feeds, catalog, bronze, audit, silver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.functions.series import largest_step
from tickloom.plans import marts
from tickloom.plans.daily import Scoring, daily_run, ingest
from tickloom.registry.adapters import PAIRS, Warehouse
from tickloom.registry.spec import Entry
from tickloom.session import fresh_path
from tickloom.sources import bronze, catalog, feeds, store, tables
from tickloom.sources.generations import Generations, Snapshot

BAR = "symbol:s ts:t page:i open:d6 high:d6 low:d6 close:d6 volume:d6"

#: Pages as the adapter lays them out: home page, plus the first five days repeated one page early.
PAGES = """
    (SELECT symbol, ts, open, high, low, close, coalesce(volume, 1) AS volume,
            date_diff('day', DATE '1970-01-01', ts) // 300 AS page FROM bars
     UNION ALL
     SELECT symbol, ts, open, high, low, close + 1, coalesce(volume, 1),
            date_diff('day', DATE '1970-01-01', ts) // 300 - 1
     FROM bars WHERE date_diff('day', DATE '1970-01-01', ts) % 300 < 5)
"""


def _catalog_csv(w: Warehouse):
    path = fresh_path(w.spark, "catalog-csv")
    w.catalog.select("symbol", "asset_class", "region", "name", "has_volume", "fx_pair").write.mode(
        "overwrite"
    ).csv(path, header=True)
    return catalog.read_catalog(w.spark, path)


def _derived(w: Warehouse):
    known = F.col("symbol") != "3-MEDIUM"
    partial = w.catalog.select(
        "symbol",
        "asset_class",
        F.when(known, F.col("region")).alias("region"),
        F.when(known, F.col("name")).alias("name"),
        "fx_pair",
    )
    return catalog.derive_catalog(partial)


def _landing(w: Warehouse):
    """Raw candles with every fourth one arriving twice."""
    first = w.raw.withColumn("arrival", F.lit(1))
    again = w.raw.where("k % 4 = 0").withColumn("arrival", F.lit(2)).withColumn(
        "payload", F.lit("{}")
    )
    return first.unionByName(again)


def _stored_half(w: Warehouse) -> str:
    """A candle store that holds every second candle."""
    path = fresh_path(w.spark, "candle-store")
    store.append_candles(w.spark, w.raw.where("k % 2 = 0"), path)
    return path


def _appended(w: Warehouse):
    """The store after an append that offers stored and new candles, every fourth one twice."""
    path = _stored_half(w)
    store.append_candles(w.spark, _landing(w), path, first_by="arrival")
    return store.read_store(w.spark, path).withColumn(
        "close", F.get_json_object("payload", "$.close").cast("double")
    )


def _appended_months(w: Warehouse):
    """What an increment of the years 1996 and 1997 offers and inserts, by partition."""
    path = _stored_half(w)
    late = _landing(w).where(F.year("candle_ts").between(1996, 1997))
    return store.append_candles(w.spark, late, path, first_by="arrival").by_month()


def _replicated(w: Warehouse):
    pieces = []
    inputs = {
        "ingest_runs": (w.audit, w.audit.where("ingest_run_id % 3 = 0")),
        "raw_candles": (
            w.raw.withColumn("raw_candle_id", F.col("k")), w.raw.where("k % 3 = 0"),
        ),
    }
    for relation, key in bronze.REPLICATED:
        source, target = inputs[relation]
        _, counts = bronze.replicate(source, target, key)
        pieces.append(counts.withColumn("relation", F.lit(relation)))
    return pieces[0].unionByName(pieces[1])


def _wanted(w: Warehouse):
    return (
        w.raw.select("source", "symbol", "granularity")
        .distinct()
        .withColumn("backfill_start", F.lit(dt.datetime(1994, 1, 1)).cast("timestamp"))
    )


def _windows(w: Warehouse):
    known = w.raw.where("k % 2 = 0 and symbol <> '3-MEDIUM'")
    now = F.lit(w.as_of + dt.timedelta(hours=12))
    return bronze.fetch_windows(_wanted(w), bronze.high_water_marks(known), now)


WINDOWS_SQL = """
    SELECT source, symbol, max(ts) FILTER (k % 2 = 0 AND symbol <> '3-MEDIUM') AS watermark,
           coalesce(max(ts) FILTER (k % 2 = 0 AND symbol <> '3-MEDIUM') + INTERVAL 1 DAY,
                    TIMESTAMP '1994-01-01') AS window_start,
           date_trunc('day', (SELECT as_of FROM clock) + INTERVAL 12 HOUR) - INTERVAL 1 DAY
               AS window_end
    FROM typed GROUP BY source, symbol
"""


def _audited(w: Warehouse):
    attempts = _wanted(w).drop("backfill_start").withColumn(
        "error",
        F.when(
            F.col("symbol") == "2-HIGH",
            F.concat(F.lit("HTTPError: https://feed?api_key=abc&s="), F.col("symbol")),
        ),
    )
    stored = w.raw.where("k % 2 = 0")
    return bronze.audit_rows(attempts, w.raw, bronze.unseen(w.raw, stored), F.lit(w.as_of))


def _page_windows(w: Warehouse):
    spans = w.bars.groupBy("symbol").agg(
        F.min("ts").alias("window_start"), F.max("ts").alias("window_end")
    )
    return feeds.page_windows(spans)


def _clipped(w: Warehouse):
    bars, _ = feeds.coinbase_bars(w.responses("coinbase"))
    day = dt.datetime
    return feeds.clip_window(bars, F.lit(day(1996, 1, 1)), F.lit(day(2000, 12, 31)))


PARSERS = {
    "coinbase": feeds.coinbase_bars,
    "kraken": feeds.kraken_bars,
    "equity": feeds.equity_bars,
    "fx": feeds.fx_bars,
}


def _damaged(w: Warehouse, kind: str):
    """An error object, a cut-off text and a bad first candle in three of five pages."""
    bad = F.lit('{"date":"soon","open":1,"high":1,"low":1,"close":1}' if kind != "coinbase" else "[1]")
    text, turn = F.col("response"), F.col("page") % 5
    damaged = (
        F.when(turn == 0, F.lit('{"message":"rate limit"}'))
        .when(turn == 1, F.substring(text, F.lit(1), F.length(text) - 2))
        .when(turn == 2, F.concat(F.lit("["), bad, F.lit(","), F.substring(text, F.lit(2), F.length(text))))
        .otherwise(text)
    )
    # pages of the second venue already hold errors and missing lists
    pages = w.responses(kind)
    return pages if kind == "kraken" else pages.withColumn("response", damaged)


def _feed_rejects(w: Warehouse):
    parts = [parse(_damaged(w, kind)) for kind, parse in PARSERS.items()]
    kept = None
    for bars, rejects in parts:
        part = (
            bars.select("source", "symbol", "page", F.lit(None).cast("string").alias("reason"))
            .unionByName(rejects.select("source", "symbol", "page", "reason"))
            .groupBy("source", "symbol", "page", "reason").agg(F.count(F.lit(1)).alias("n"))
        )
        kept = part if kept is None else kept.unionByName(part)
    return kept


#: Text the JSON functions would write anew: a trailing zero, 21 digits, spaces, and quoted marks.
KEPT = '"exact": 1.10,"long":123456789012.123456789,"note":"a, ]}\\" [b", "nested":[{"x":1.0},[ ]]'


def _raw_payload(w: Warehouse):
    """Dated rows with fields the parser does not know, and prices written as text."""
    kept = []
    for kind in ("equity", "fx"):
        pages = w.responses(kind)
        text = F.regexp_replace("response", r'"open":([^,]+)', r'"open":"$1",@')
        pages = pages.withColumn("response", F.replace(text, F.lit("@"), F.lit(KEPT)))
        bars, _ = PARSERS[kind](pages)
        whole = bars.join(pages.select("symbol", "page", "response"), ["symbol", "page"])
        kept.append(whole.withColumn("byte_equal", F.col("response").contains(F.col("payload"))))
    field = F.regexp_extract
    return kept[0].unionByName(kept[1]).withColumns(
        {
            "payload_open": field("payload", r'"open":"([^"]+)"', 1),
            "exact": field("payload", r'"exact": ([^,]+),', 1),
            "long": field("payload", r'"long":([^,]+),', 1),
            "tail": F.substring_index("payload", '"note"', -1).contains('"nested":[{"x":1.0},[ ]]'),
        }
    )


#: A first candle whose number is the text or the literal of no number.
NO_NUMBERS = {
    "coinbase": ("[", "[[0,NaN,1,1,1,1],"),
    "kraken": ('":[[', '":[[0,"1","NaN","1","1","1","1",7],['),
    "equity": ("[", '[{"date":"2000-01-01T00:00:00Z","open":"NaN","high":1,"low":1,"close":1,"volume":1},'),
    "fx": ("[", '[{"date":"2000-01-01T00:00:00Z","open":1,"high":1,"low":1,"close":"-Infinity"},'),
}


def _number_rejects(w: Warehouse):
    """Every page of every feed begins with a candle that holds no number; bars are counted too."""
    kept = None
    for kind, parse in PARSERS.items():
        first, bad = NO_NUMBERS[kind]
        at = F.instr("response", first)
        text = F.col("response")
        damaged = F.concat(
            F.substring(text, F.lit(1), at - 1), F.lit(bad), F.substring(text, at + len(first), F.length(text))
        )
        pages = w.responses(kind).withColumn("response", F.when(at > 0, damaged).otherwise(text))
        bars, rejects = parse(pages)
        part = rejects.where("reason = 'unreadable number'").groupBy("source", "symbol").agg(
            F.count(F.lit(1)).alias("rejected")
        )
        counted = bars.groupBy("source", "symbol").agg(
            F.count(F.lit(1)).alias("bars"), F.count_if(F.isnan("open") | F.isnan("close")).alias("nan_bars")
        )
        both = part.join(counted, ["source", "symbol"])
        kept = both if kept is None else kept.unionByName(both)
    return kept


def _outcomes(w: Warehouse):
    """The whole stream, and the part whose credentials were accepted."""
    everything = bronze.run_outcome(w.audit).withColumn("part", F.lit("all"))
    accepted = bronze.run_outcome(w.audit.where("not auth_failed"))
    return everything.unionByName(accepted.withColumn("part", F.lit("accepted")))


DAILY_FEEDS = {
    "coinbase": feeds.coinbase_bars, "kraken": feeds.kraken_bars, "equity": feeds.equity_bars,
    "fx": feeds.fx_bars,
}


def _daily_inputs(w: Warehouse, first_venue):
    responses = {kind: (parse, w.responses(kind)) for kind, parse in DAILY_FEEDS.items()}
    responses["coinbase"] = (feeds.coinbase_bars, first_venue)
    return responses


def _backfill():
    return F.lit(dt.datetime(1990, 1, 1)).cast("timestamp")


def _daily(w: Warehouse, root: str, first_venue) -> Snapshot:
    """One day of the job over the pages of all four feeds."""
    scoring = Scoring(w.signals, w.variants, w.costs)
    now = F.lit(w.as_of + dt.timedelta(hours=36)).cast("timestamp")
    daily_run(w.spark, root, _daily_inputs(w, first_venue), w.catalog, scoring, now, _backfill())
    return Generations(w.spark, root).current()


def _daily_runs(w: Warehouse):
    """Runs of a day that finds a store filled until some years before it."""
    root = fresh_path(w.spark, "daily")
    pages = w.responses("coinbase")
    then = F.lit(w.as_of - dt.timedelta(days=900)).cast("timestamp")
    ingest(w.spark, f"{root}/candles", _daily_inputs(w, pages), then, _backfill())
    return _daily(w, root, pages).read("runs")


def _daily_isolated(w: Warehouse):
    """One zero price in one symbol: that symbol is quarantined, all others are scored."""
    root = fresh_path(w.spark, "daily-isolated")
    pages = w.responses("coinbase")
    newest = pages.groupBy("symbol").agg(F.max("page").alias("page")).where("symbol = '2-HIGH'")
    # the last candle of the newest page, as [time,low,high,open,close,volume]
    zeroed = F.regexp_replace(
        "response", r"\[(\d+),([^,\]]+),([^,\]]+),[^,\]]+,([^,\]]+),([^,\]]+)\]\]$", r"[$1,$2,$3,0,$4,$5]]"
    )
    marked = pages.join(newest.withColumn("hit", F.lit(True)), ["symbol", "page"], "left")
    damaged = marked.withColumn("response", F.when(F.col("hit"), zeroed).otherwise(F.col("response")))
    snapshot = _daily(w, root, damaged.drop("hit"))
    runs = snapshot.read("runs").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("total_return").alias("avg_return")
    )
    held = snapshot.read("quarantine").groupBy("symbol").agg(
        F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons")
    )
    bars = snapshot.read("bars").groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"))
    return bars.join(runs, "symbol", "left").join(held, "symbol", "left")


def _snapshots(w: Warehouse):
    """What a reader that began before the second day sees, beside one that begins after it."""
    root = fresh_path(w.spark, "generations")
    generations = Generations(w.spark, root)

    def write(bars) -> None:
        draft = generations.begin()
        draft.put("bars", bars, by=("symbol",))
        draft.put("audit", None)
        draft.put("spans", bars.groupBy("symbol").agg(F.max("ts").alias("last_ts")))
        draft.publish(F.lit(w.as_of))

    write(w.bars.where("k % 2 = 0"))
    before = generations.current()
    write(w.bars)
    seen = None
    for snapshot in (before, generations.current()):
        part = (
            snapshot.read("bars").groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"))
            .join(snapshot.read("spans"), "symbol")
            .withColumn("generation", F.lit(snapshot.number))
        )
        seen = part if seen is None else seen.unionByName(part)
    stored = generations.history("bars").groupBy("symbol", "generation").agg(F.count(F.lit(1)).alias("stored"))
    return seen.join(stored, ["symbol", "generation"])


def _fallback(w: Warehouse):
    """The variant mart is absent, so the plain runs are published."""
    from tickloom.sources.json_sinks import variant_entries

    source = tables.first_available(w.spark, fresh_path(w.spark, "absent-mart"), w.runs)
    return variant_entries(source)


def _rebuilt(w: Warehouse):
    path = fresh_path(w.spark, "layer-indicators")
    layer = tables.rebuild(w.indicator_rows, path)
    return layer.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.count("sma_200").alias("with_sma_200")
    )


def _gaps(w: Warehouse):
    dated = w.bars.select("symbol", "ts", F.to_date("ts").alias("day"))
    return largest_step(dated, "day", ("symbol",))


def _weekdays(w: Warehouse):
    rows = w.bars.join(w.catalog.select("symbol", "asset_class"), "symbol")
    kept = rows.where((F.col("asset_class") == "crypto") | (F.weekday(F.to_date("ts")) < 5))
    return kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("calendar_bars"))


ENTRIES = [
    Entry("coinbase_parse", "S1", BAR, lambda w: feeds.coinbase_bars(w.responses("coinbase"))[0],
          f"SELECT * FROM {PAGES}"),
    Entry("kraken_parse", "S2", BAR, lambda w: feeds.kraken_bars(w.responses("kraken"))[0],
          f"SELECT * FROM {PAGES} WHERE page % 5 > 1"),
    Entry("kraken_rejects", "S2", "symbol:s page:i reason:s",
          lambda w: feeds.kraken_bars(w.responses("kraken"))[1],
          f"""SELECT DISTINCT symbol, page, CASE page % 5 WHEN 0 THEN 'venue error: EGeneral:Busy'
              ELSE 'no candle list' END AS reason FROM {PAGES} WHERE page % 5 < 2"""),
    Entry("equity_parse", "S3", BAR, lambda w: feeds.equity_bars(w.responses("equity"))[0],
          f"SELECT * FROM {PAGES}"),
    Entry("fx_parse", "S4", BAR, lambda w: feeds.fx_bars(w.responses("fx"))[0],
          f"SELECT * REPLACE (NULL AS volume) FROM {PAGES}"),
    Entry("feed_rejects", "S1 S2 S3 S4", "source:s symbol:s page:i reason:s n:i", _feed_rejects,
          f"""WITH pages AS (SELECT symbol, page, count(*) AS n FROM {PAGES} GROUP BY 1, 2),
              feeds(source, short) AS (VALUES ('coinbase', 'incomplete candle'),
                  ('tiingo', 'unreadable time'), ('tiingo_fx', 'unreadable time'))
              SELECT source, symbol, page, CASE WHEN page % 5 < 2 THEN 'no candle list' END
                  AS reason, CASE WHEN page % 5 < 2 THEN 1 ELSE n END AS n FROM pages, feeds
              UNION ALL SELECT source, symbol, page, short, 1 FROM pages, feeds WHERE page % 5 = 2
              UNION ALL SELECT 'kraken', symbol, page, CASE page % 5
                  WHEN 0 THEN 'venue error: EGeneral:Busy' WHEN 1 THEN 'no candle list' END,
                  CASE WHEN page % 5 < 2 THEN 1 ELSE n END FROM pages"""),
    Entry("raw_payload_roundtrip", "S3 S4",
          "source:s symbol:s ts:t page:i open:d6 payload_open:d6 exact:s long:s tail:b byte_equal:b",
          _raw_payload,
          f"""SELECT *, open AS payload_open, '1.10' AS exact, '123456789012.123456789' AS long,
                     true AS tail, true AS byte_equal
              FROM {PAGES}, (VALUES ('tiingo'), ('tiingo_fx')) f(source)"""),
    Entry("feed_number_rejects", "S1 S2 S3 S4", "source:s symbol:s rejected:i bars:i nan_bars:i",
          _number_rejects,
          f"""WITH pages AS (SELECT symbol, page, count(*) AS n FROM {PAGES} GROUP BY 1, 2),
              feeds(source) AS (VALUES ('coinbase'), ('kraken'), ('tiingo'), ('tiingo_fx'))
              SELECT source, symbol, count(*) AS rejected, sum(n) AS bars, 0 AS nan_bars
              FROM pages, feeds WHERE source <> 'kraken' OR page % 5 > 1 GROUP BY 1, 2"""),
    Entry("venue_pairs", "S5", "symbol:s ts:t pair:s ticker:s",
          lambda w: feeds.map_symbols(w.bars, PAIRS)[0].withColumn(
              "ticker", feeds.fx_ticker(F.col("symbol"))),
          """SELECT symbol, ts, 'X' || split_part(symbol, '-', 2) AS pair, lower(symbol) AS ticker
             FROM bars WHERE symbol < '4'"""),
    Entry("venue_pair_rejects", "S5", "symbol:s ts:t",
          lambda w: feeds.map_symbols(w.bars, PAIRS)[1],
          "SELECT symbol, ts FROM bars WHERE symbol >= '4'"),
    Entry("page_overlap_clip", "S6", "source:s symbol:s ts:t open:d6 close:d6 volume:d6",
          _clipped,
          """SELECT 'coinbase' AS source, symbol, ts, open, close, coalesce(volume, 1) AS volume
             FROM bars WHERE ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'"""),
    Entry("catalog_csv", "S7",
          "symbol:s asset_class:s region:s name:s has_volume:b fx_pair:s", _catalog_csv,
          "SELECT * FROM catalog"),
    Entry("catalog_derivation", "S8",
          "symbol:s asset_class:s region:s name:s has_volume:b fx_pair:s periods_per_year:i",
          _derived,
          """SELECT symbol, asset_class, has_volume, fx_pair,
                    CASE symbol WHEN '3-MEDIUM' THEN 'global' ELSE region END AS region,
                    CASE symbol WHEN '3-MEDIUM' THEN symbol ELSE name END AS name,
                    CASE asset_class WHEN 'crypto' THEN 365 ELSE 252 END AS periods_per_year
             FROM catalog"""),
    Entry("bronze_dedup_append", "S9", "source:s symbol:s candle_ts:t close:d9", _appended,
          "SELECT source, symbol, ts AS candle_ts, close FROM typed"),
    Entry("bronze_pruned_append", "S9 S10", "source:s month:s offered:i inserted:i", _appended_months,
          """SELECT source, strftime(ts, '%Y-%m') AS month,
                    count(*) + count_if(k % 4 = 0) AS offered, count_if(k % 2 = 1) AS inserted
             FROM typed WHERE year(ts) IN (1996, 1997) GROUP BY 1, 2"""),
    Entry("bronze_replication", "S10 S11", "relation:s rows_sent:i rows_inserted:i", _replicated,
          """SELECT 'ingest_runs' AS relation, count(*) AS rows_sent,
                    count_if(ingest_run_id % 3 <> 0) AS rows_inserted FROM audit
             UNION ALL SELECT 'raw_candles', count(*), count_if(k % 3 <> 0) FROM typed"""),
    Entry("optional_relation", "S17 P17 P18",
          "symbol:s strategy:s n_components:i excess_return:d6 oos_excess_return:d6 "
          "beat_bh_full:b beat_bh_oos:b n_trades:i", _fallback,
          """SELECT symbol, strategy, n_components, n_trades,
                    round_even(total_return - buy_hold_return, 6) AS excess_return,
                    round_even(oos_total_return - oos_buy_hold_return, 6) AS oos_excess_return,
                    total_return > buy_hold_return AS beat_bh_full,
                    oos_total_return > oos_buy_hold_return AS beat_bh_oos FROM runs"""),
    Entry("layer_rebuild", "S18", "symbol:s bars:i with_sma_200:i", _rebuilt,
          """SELECT symbol, count(*) AS bars, count(*) - 199 AS with_sma_200
             FROM bars GROUP BY 1"""),
    Entry("layer_generations", "S12 S18", "generation:i symbol:s bars:i stored:i last_ts:t", _snapshots,
          """SELECT 1 AS generation, symbol, count(*) AS bars, count(*) AS stored, max(ts) AS last_ts
             FROM bars WHERE k % 2 = 0 GROUP BY symbol
             UNION ALL SELECT 2, symbol, count(*), count(*), max(ts) FROM bars GROUP BY symbol"""),
    Entry("daily_run", "S9 S12 S18 Q13 B27 M11",
          "symbol:s strategy:s n_components:i n_bars:i total_return:d6 buy_hold_return:d6 sharpe:d4 "
          "n_trades:i oos_total_return:d6 split_ts:t", _daily_runs, "SELECT * FROM runs"),
    Entry("daily_run_isolated", "Q13 B17 B27", "symbol:s bars:i n_runs:i avg_return:d6 reasons:s",
          _daily_isolated,
          """SELECT b.symbol, b.bars, r.n_runs, r.avg_return,
                    CASE b.symbol WHEN '2-HIGH' THEN 'bad_price,bad_shape' END AS reasons
             FROM (SELECT symbol, count(*) AS bars FROM bars GROUP BY 1) b
             LEFT JOIN (SELECT symbol, count(*) AS n_runs, avg(total_return) AS avg_return FROM runs
                        WHERE symbol <> '2-HIGH' GROUP BY 1) r USING (symbol)"""),
    Entry("high_water_marks", "I1", "source:s symbol:s watermark:t",
          lambda w: bronze.high_water_marks(w.raw),
          "SELECT source, symbol, max(ts) AS watermark FROM typed GROUP BY 1, 2"),
    Entry("watermark_window", "I2",
          "source:s symbol:s watermark:t window_start:t window_end:t is_empty:b", _windows,
          f"SELECT *, window_start > window_end AS is_empty FROM ({WINDOWS_SQL})"),
    Entry("new_candles", "I3", "source:s symbol:s candle_ts:t",
          lambda w: bronze.select_new(w.raw, _windows(w)),
          f"""SELECT t.source, t.symbol, t.ts AS candle_ts FROM typed t JOIN ({WINDOWS_SQL}) w
              ON t.source = w.source AND t.symbol = w.symbol
              WHERE t.ts >= window_start AND t.ts <= window_end"""),
    Entry("audit_rollup", "I4",
          "source:s symbol:s rows_fetched:i rows_inserted:i status:s error:s finished_at:t",
          _audited,
          """SELECT source, symbol, count(*) AS rows_fetched,
                    CASE symbol WHEN '2-HIGH' THEN 0 ELSE count_if(k % 2 = 1) END AS rows_inserted,
                    CASE symbol WHEN '2-HIGH' THEN 'failed' ELSE 'success' END AS status,
                    CASE symbol WHEN '2-HIGH' THEN
                        'HTTPError: https://feed?api_key=***&s=2-HIGH' END AS error,
                    (SELECT as_of FROM clock) AS finished_at
             FROM typed GROUP BY source, symbol"""),
    Entry("redact_text", "I5", "ingest_run_id:i masked:s",
          lambda w: w.audit.withColumn("masked", scalars.mask_secrets(F.col("error"))),
          """SELECT ingest_run_id, regexp_replace(error, '\\b(token|api_key)=[^&\\s]+',
                    '\\1=***', 'gi') AS masked FROM audit"""),
    Entry("run_outcome", "I6",
          "part:s n_ok:i n_failed:i n_deferred:i n_refused:i publishable:b", _outcomes,
          """SELECT part, count_if(status = 'success') AS n_ok,
                    count_if(status = 'failed' AND NOT rate_limited) AS n_failed,
                    count_if(rate_limited) AS n_deferred, count_if(auth_failed) AS n_refused,
                    count_if(auth_failed) = 0
                    AND count_if(status = 'success') + count_if(rate_limited) > 0 AS publishable
             FROM audit, (VALUES ('all'), ('accepted')) t(part)
             WHERE part = 'all' OR NOT auth_failed GROUP BY part"""),
    Entry("page_windows", "I7", "symbol:s page_start:t page_end:t", _page_windows,
          """SELECT symbol, lo + to_days((300 * i)::INT) AS page_start,
                    least(lo + to_days((300 * i + 299)::INT), hi) AS page_end
             FROM (SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY 1),
                  range(0, 100) r(i) WHERE lo + to_days((300 * i)::INT) <= hi"""),
    Entry("bronze_parse", "P1 P2 P3 M1",
          "source:s symbol:s granularity:s ts:t open:d6 high:d6 low:d6 close:d9 volume:d6 "
          "adj_close:d6 is_zero_volume:b has_null_price:b high_lt_low:b",
          lambda w: w.typed, "SELECT * FROM flagged"),
    Entry("source_priority_dedup", "W7 M2",
          "source:s symbol:s granularity:s ts:t open:d6 close:d9 volume:d6 adj_close:d6 "
          "is_zero_volume:b", lambda w: w.canonical, "SELECT * FROM canon"),
    Entry("utc_dates", "P6", "day:D attempts:i",
          lambda w: w.audit.groupBy(F.to_date("started_at").alias("day")).agg(
              F.count(F.lit(1)).alias("attempts")),
          "SELECT started_at::DATE AS day, count(*) AS attempts FROM audit GROUP BY 1"),
    Entry("weekday_filter", "P7", "symbol:s calendar_bars:i", _weekdays,
          """SELECT symbol, count(*) AS calendar_bars FROM bars JOIN catalog USING (symbol)
             WHERE asset_class = 'crypto' OR dayname(ts) NOT IN ('Saturday', 'Sunday')
             GROUP BY 1"""),
    Entry("annualisation", "P8", "symbol:s factor:d9",
          lambda w: w.catalog.withColumn(
              "factor", F.sqrt(scalars.periods_per_year(F.col("asset_class")))),
          """SELECT symbol, sqrt(CASE asset_class WHEN 'crypto' THEN 365 ELSE 252 END) AS factor
             FROM catalog"""),
    Entry("numeric_frame", "P23", "symbol:s ts:t close:d6 volume:d6 k:d1",
          lambda w: scalars.numeric_frame(w.bars),
          "SELECT symbol, ts, close, volume, k FROM bars"),
    Entry("calendar_gaps", "A2", "symbol:s largest_step:i", _gaps,
          """SELECT symbol, max(gap) AS largest_step FROM (SELECT symbol, date_diff('day',
                    lag(ts) OVER (PARTITION BY symbol ORDER BY ts), ts) AS gap FROM bars)
             GROUP BY 1"""),
    Entry("calendar_spine", "J9 A3", "symbol:s day:D",
          lambda w: marts.calendar_days(
              w.bars.groupBy("symbol").agg(F.to_date(F.min("ts")).alias("first_date"),
                                           F.to_date(F.max("ts")).alias("last_date"))
              .join(w.catalog.select("symbol", "asset_class"), "symbol")),
          """SELECT symbol, (lo + to_days(i::INT))::DATE AS day
             FROM (SELECT symbol, asset_class, min(ts) AS lo, max(ts) AS hi FROM bars
                   JOIN catalog USING (symbol) GROUP BY 1, 2), range(0, 20000) r(i)
             WHERE lo + to_days(i::INT) <= hi
               AND (asset_class = 'crypto' OR isodow(lo + to_days(i::INT)) < 6)"""),
    Entry("recent_ingest", "K1",
          "source:s symbol:s status:s rows_fetched:i rows_inserted:i finished_at:t",
          lambda w: marts.recent_attempts(w.audit, 40),
          "SELECT * FROM audit ORDER BY started_at DESC, source, symbol, ingest_run_id LIMIT 40"),
]
