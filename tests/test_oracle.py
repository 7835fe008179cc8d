"""Every registered query against its SQL counterpart on the given tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as registry
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan
    result = oracle.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
