"""Registered queries vs their DuckDB oracle on sf0.001 (exact values)."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SKIP_SLOW = {"bronze_manifest", "silver_manifest", "gold_manifest"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def val(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(v) if isinstance(v, float) else str(v)
    return sorted("|".join(val(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP_SLOW - set(entry.TEXT_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    sql = entry.oracle_sql()[name]
    res = duck.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    s_rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _norm(s_rows, df.columns) == _norm(o_rows, o_cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["exchange", "symbol", "avg_close_30d"] and len(rows) == 10
