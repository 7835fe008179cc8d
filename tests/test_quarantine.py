"""Quarantine against a row-by-row restatement of its rules, on both ways of labelling rows."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from tallybridge import load_spec, parse_spec
from tallybridge.operators.keysets import Budget
from tallybridge.operators.quarantine import classify, loaded_rows, mark_duplicates, rejected_rows
from workloads.extracts import extract

# "split" broadcasts nothing whole and splits off keys with more than two rows; "payload" has room
# for a few keys, but not for the positions of their first rows.
BUDGETS = {
    "broadcast": Budget(),
    "split": Budget(rows=0, bytes=0, hot_keys=10**6, hot_rows=2),
    "payload": Budget(rows=100, bytes=400, hot_keys=10**6, hot_rows=2),
}

SPEC = parse_spec(
    {
        "parent": {
            "source": "P",
            "key": {"source": "ID", "target": "No."},
            "dedupe_on": ["No."],
            "fields": {
                "No.": {"from": "ID", "rules": ["trim", "upper"]},
                "Name": {"from": "NAME", "rules": ["trim"]},
            },
            "required": ["Name"],
        },
        "child": {
            "source": "C",
            "key": {"source": "REF", "target": "Ref"},
            "fields": {
                "Ref": {"from": "REF"},
                "Parent": {"from": "ID", "rules": ["trim", "upper"]},
                "Amount": {"from": "AMT", "rules": ["to_decimal"]},
            },
            "foreign_keys": {"Parent": "parent"},
        },
    }
)


def random_rows(seed):
    rng = random.Random(seed)
    ids = [None, "a", "A ", "b", "c", "D", "e ", " E", "f"]
    # "hot" owns a third of the rows.
    pick = lambda: "hot" if rng.random() < 0.33 else rng.choice(ids)
    parents = [(i, pick(), rng.choice([None, "", " ", "n", "m"])) for i in range(60)]
    children = [
        (i, f"r{i}", rng.choice([pick(), "zz", "hot2"]), rng.choice(["1.5", "x", "", None]))
        for i in range(90)
    ]
    return parents, children


def clean(text):
    return None if text is None else text.strip().upper()


def expected(parents, children):
    seen, loaded, parent_reasons = set(), set(), {}
    for at, key, name in parents:
        no = clean(key)
        reason = None
        if name is None or not name.strip():
            reason = "missing_required:Name"
        elif no in seen:
            reason = "duplicate_after_normalisation"
        seen.add(no)
        parent_reasons[at] = reason
        if reason is None:
            loaded.add(no)
    child_reasons = {}
    for at, _, key, amount in children:
        reason = None
        if amount == "x":
            reason = "invalid_number:Amount"
        elif clean(key) is None or clean(key) not in loaded:
            reason = "orphan:Parent"
        child_reasons[at] = reason
    return parent_reasons, child_reasons


@pytest.mark.parametrize("budget", BUDGETS.values(), ids=BUDGETS)
@pytest.mark.parametrize("seed", [1, 2])
def test_reasons_match_row_by_row_rules(spark, budget, seed):
    parents, children = random_rows(seed)
    p = spark.createDataFrame(parents, "_source_row bigint, ID string, NAME string").repartition(5)
    c = spark.createDataFrame(children, "_source_row bigint, REF string, ID string, AMT string")
    done = classify(SPEC["parent"], p, budget=budget)
    reasons = {r["_source_row"]: r["reject_reason"] for r in done.collect()}
    want_parents, want_children = expected(parents, children)
    assert reasons == want_parents
    loaded = {"parent": (loaded_rows(done, SPEC["parent"]), "No.")}
    result = classify(SPEC["child"], c.repartition(5), loaded, budget=budget).collect()
    assert len(result) == len(children)
    assert {r["_source_row"]: r["reject_reason"] for r in result} == want_children


@pytest.mark.parametrize("budget", BUDGETS.values(), ids=BUDGETS)
def test_full_copies_keep_exactly_one_row(spark, budget, tmp_path):
    rows = [("k", 1, "x")] * 40 + [("k", 0, "y"), (None, 5, "z"), (None, 5, "z"), ("u", 1, "x")]
    path = str(tmp_path / "copies")
    spark.createDataFrame(rows, "key string, n int, t string").repartition(4).write.parquet(path)
    placed = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    marked = mark_duplicates(placed, ["key"], ["n", "t", "file", "at"], budget=budget)
    kept = [(r.key, r.n, r.t) for r in marked.filter(~F.col("is_duplicate")).collect()]
    assert marked.count() == len(rows)
    assert sorted(kept, key=str) == sorted([("k", 0, "y"), (None, 5, "z"), ("u", 1, "x")], key=str)


def test_composite_keys(spark):
    rows = [(0, "a", None), (1, "a", None), (2, "a", "x"), (3, None, "x"), (4, None, "x")]
    df = spark.createDataFrame(rows, "_source_row bigint, k1 string, k2 string")
    for budget in BUDGETS.values():
        marked = mark_duplicates(df, ["k1", "k2"], budget=budget)
        assert {r._source_row for r in marked.collect() if r.is_duplicate} == {1, 4}


def test_rejects_keep_the_raw_source(spark):
    df = spark.createDataFrame(
        [(0, " a ", "n"), (1, "A", "n")], "_source_row bigint, ID string, NAME string"
    )
    done = classify(SPEC["parent"], df)
    assert [tuple(r) for r in rejected_rows(done).collect()] == [
        ("A", "n", "duplicate_after_normalisation")
    ]
    assert [tuple(r) for r in loaded_rows(done, SPEC["parent"]).collect()] == [("A", "n")]


def test_source_without_order_is_refused(spark):
    df = spark.createDataFrame([("a", "n")], "ID string, NAME string")
    with pytest.raises(KeyError):
        classify(SPEC["parent"], df)


def test_order_columns_of_the_user(spark):
    rows = [("a", "x", 2, "u"), ("A", "y", 1, "v"), ("b", "z", 1, "u")]
    df = spark.createDataFrame(rows, "ID string, NAME string, day int, batch string")
    done = classify(SPEC["parent"], df, order_by=["day", "batch"])
    assert {tuple(r) for r in loaded_rows(done, SPEC["parent"]).collect()} == {
        ("A", "y"), ("B", "z"),
    }
    again = df.union(df.limit(1))
    with pytest.raises(ValueError):
        classify(SPEC["parent"], again, order_by=["day", "batch"])


def test_wide_rows_are_not_shuffled_when_verdicts_are_few(spark, sf_dir):
    entity = load_spec()["vendor"]
    plan = classify(entity, extract(spark, sf_dir, "VENDTABLE"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_rows_of_frequent_keys_are_spread(spark):
    """A key with a third of all rows must not end up in one partition of the fallback join."""
    rows = spark.range(3000).selectExpr(
        "id AS _source_row", "IF(id % 3 = 0, 'hot', concat('k', cast(id % 1000 AS string))) AS key"
    )
    budget = Budget(rows=0, bytes=0, hot_keys=10**6, hot_rows=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = mark_duplicates(rows.repartition(4), ["key"], budget=budget)
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 3000
    assert max(sizes) < 800


@pytest.mark.parametrize("name", ["customer", "vendor", "item"])
def test_generated_code_stays_compilable(spark, sf_dir, name):
    """Methods above 8000 bytes of bytecode are never compiled by the JVM and run many times slower."""
    entity = load_spec()[name]
    plan = classify(entity, extract(spark, sf_dir, entity.source))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as text:
            plan.select("*").explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_order_columns_may_be_mapped_and_stay_in_rejects(spark):
    rows = [("p3", " a", "n"), ("p1", "A", "m"), ("p2", "b", None)]
    source = spark.createDataFrame([(a, n) for _, a, n in rows], "ID string, NAME string")
    spec = parse_spec(
        {
            "parent": {
                "source": "P",
                "key": {"source": "ID", "target": "No."},
                "dedupe_on": ["No."],
                "fields": {
                    "No.": {"from": "ID", "rules": ["trim", "upper"]},
                    "Name": {"from": "NAME", "rules": ["trim"]},
                },
                "required": ["Name"],
            }
        }
    )
    done = classify(spec["parent"], source, order_by=["ID"])
    got = {tuple(r) for r in rejected_rows(done).collect()}
    # a blank sorts before a letter, so " a" is the first of its key
    assert got == {("A", "m", "duplicate_after_normalisation"), ("b", None, "missing_required:Name")}
