"""Change sets against a row-by-row restatement, and loading them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybridge.operators import changes as C
from tallybridge.operators.keysets import Budget
from tallybridge.session import materialise

SCHEMA = "k long, c string, v string, n double"
KEYS = ["k", "c"]


def restated(old, new):
    """What has to be inserted, updated and deleted, key by key."""
    out = []
    for key in {r[:2] for r in old} | {r[:2] for r in new}:
        before, after = ([r for r in rows if r[:2] == key] for rows in (old, new))
        if Counter(before) == Counter(after):
            continue
        if not after:
            out += [(*r, "delete") for r in before]
        else:
            out += [(*r, "update" if before else "insert") for r in after]
    return sorted(out, key=repr)


def versions(seed):
    rng = random.Random(seed)
    row = lambda k: (k, rng.choice(["a", "b", "", None]), rng.choice(["x", "", None, "y|z"]), rng.choice([1.5, None, -0.25]))
    old = [row(rng.choice([None, *range(40)])) for _ in range(90)] + [(7, "hot", f"v{i % 5}", 1.0) for i in range(60)]
    new = [r for r in old if rng.random() < 0.8]
    new = [(*r[:2], "changed", r[3]) if rng.random() < 0.1 else r for r in new]
    new += [row(100 + i) for i in range(8)]
    new += [r for r in old[:90] if rng.random() < 0.1]
    return old, new


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,budget", [(1, Budget()), (2, Budget(rows=0, hot_rows=10, hot_keys=1000)), (3, Budget(rows=0, hot_rows=10**9))])
def test_against_restatement(spark, seed, budget):
    old, new = versions(seed)
    a, b = (spark.createDataFrame(rows, SCHEMA).repartition(4) for rows in (old, new))
    found = C.change_set(a, b.select("n", "v", "c", "k"), KEYS, budget)
    assert rows_of(found.select("k", "c", "v", "n", "change")) == restated(old, new)
    assert rows_of(C.apply_changes(a, found.select("k", "c", "v", "n", "change"), KEYS, budget)) == sorted(new, key=repr)


def test_empty_sides(spark):
    old, _ = versions(4)
    a = spark.createDataFrame(old, SCHEMA)
    none = a.limit(0)
    assert rows_of(C.change_set(none, a, KEYS)) == restated([], old)
    assert rows_of(C.change_set(a, none, KEYS)) == restated(old, [])
    assert C.change_set(a, a, KEYS).isEmpty() and C.change_set(none, none, KEYS).isEmpty()
    with pytest.raises(ValueError, match="columns differ"):
        C.change_set(a, a.drop("n"), KEYS)


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(i, f"c{i}", "v", 1.0) for i in range(3000)]
    new = [r for r in old if r[0] != 17] + [(9999, "added", "v", 2.0)]
    new = [(*r[:2], "w", r[3]) if r[0] == 40 else r for r in new]
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (old, new))
    C.write_keyed(a, path, KEYS)
    files = lambda: {f for f in C.read_keyed(spark, path).inputFiles()}
    before = files()
    found = C.change_set(C.read_keyed(spark, path), b, KEYS)
    assert {r["change"] for r in found.collect()} == {"insert", "update", "delete"}
    touched = C.load_changes(spark, path, found, KEYS)
    assert len(touched) == 3
    assert {f for f in before - files()} == {f for f in before if any(f"{C.BUCKET}={t}/" in f for t in touched)}
    assert rows_of(C.read_keyed(spark, path)) == sorted(new, key=repr)
    assert C.load_changes(spark, path, C.change_set(C.read_keyed(spark, path), b, KEYS), KEYS) == []


def test_a_bucket_that_loses_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", "v", 1.0), (2, "b", "v", 1.0)], SCHEMA)
    C.write_keyed(rows, path, KEYS)
    found = materialise(C.change_set(C.read_keyed(spark, path), rows.where("k = 2"), KEYS))
    for _ in range(2):  # loading the same changes again gives the same table
        C.load_changes(spark, path, found, KEYS)
        assert rows_of(C.read_keyed(spark, path)) == [(2, "b", "v", 1.0)]


def test_plan_does_not_shuffle_wide_rows(spark):
    """While few keys changed, both sides are labelled by broadcast."""
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("c"), F.lit("v").alias("v"))
    new = rows.withColumn("v", F.when(F.col("k") == 5, "w").otherwise(F.col("v")))
    plan = C.change_set(rows, new, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
