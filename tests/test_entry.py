"""Driver contract: entry() smoke, registry/oracle coverage, and oracle agreement at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL
from ledgerspark.plans.registry import ORACLE, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "operating_margin_pct" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def canon(v):
    import datetime
    import decimal
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


@pytest.mark.parametrize("key", ["mart_pnl_summary", "mart_variance_analysis", "gate_report", "model_tests",
                                 "claim_routing", "anomaly_scorecard", "bounded_snippets", "doc_drift", "publish_round_trip",
                                 "sync_log", "latest_snippets", "source_tests", "bronze_audit", "sql_corpus", "corpus_columns",
                                 "variance_json", "gates_missing_rates", "fx_coverage_gaps"])
def test_matches_oracle_at_sf0001(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    s = sorted(tuple(repr(canon(r[c])) for c in cols) for r in sdf.collect())
    res = duck.execute(E.oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    o = sorted(tuple(repr(canon(r[i])) for i in idx) for r in res.fetchall())
    assert s == o
