"""Queries with an SQL counterpart agree with DuckDB, row for row."""

import datetime

import duckdb
import pytest

from tallybridge.llm.queries import ORACLE, QUERIES


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value.isoformat() if isinstance(value, datetime.date) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    con.execute(ORACLE[name])
    names = [d[0] for d in con.description]
    want = [dict(zip(names, map(plain, r))) for r in con.fetchall()]
    df = QUERIES[name](spark, sf_dir)
    got = [{k: plain(v) for k, v in r.asDict().items()} for r in df.collect()]
    assert sorted(df.columns) == sorted(names) and len(got) == len(want) > 0
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))
