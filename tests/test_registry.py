"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tickloom.registry import REGISTERED

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

#: The heavier stages are compared by the driver at a larger scale; here one per family.
CHOSEN = (
    "coinbase_parse", "kraken_rejects", "bronze_dedup_append", "watermark_window", "indicators",
    "source_priority_dedup", "data_quality", "fx_decomposition", "signals_macd", "trades",
    "windowed_metrics", "combination_analysis", "leaderboard", "overfitting_summary",
    "downsample_curve", "expectation_report", "index_documents", "kraken_parse", "equity_parse",
    "fx_parse", "feed_rejects", "raw_payload_roundtrip", "page_overlap_clip", "recent_ingest",
    "index_budget", "symbol_documents", "symbol_curves", "topn_per_asset", "optional_relation",
)


@pytest.fixture(scope="module")
def oracle(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    return con


def test_contract_is_complete():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(CHOSEN) <= set(queries)
    # the text queries have no SQL for hashes, token ids and trained models
    assert set(sql) <= set(queries)
    assert set(REGISTERED) <= set(sql)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, oracle, small_dir, name):
    df = contract.queries()[name](spark, small_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    cursor = oracle.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert got == want
