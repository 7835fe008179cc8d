"""Joining a dimension that is too large to broadcast, with one key in a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tallybridge import build_views, check_views
from tallybridge.operators.dimension import frequent_keys, join_dimension
from tallybridge.plans.views import VIEWS
from workloads.exports import UNMAPPED_COMPANY, exports


@pytest.fixture
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 400))
    return spark.range(60_000).select("id", key.alias("key"), (F.col("id") * 2).alias("lane"))


@pytest.fixture
def dimension(spark):
    rows = [(f"k{i}", i, "one") for i in range(390)] + [("hot", -1, "one"), ("hot", -2, "two"), ("k7", 7, "again"), (None, 0, "null"), ("unused", 0, "x")]
    return spark.createDataFrame(rows, "key string, number long, text string")


def test_rows_and_columns_are_those_of_a_join(facts, dimension):
    joined = join_dimension(facts.drop("lane"), dimension, "key", "key", ["id"]).select("s.id", "s.key", "m.number", "m.text")
    want = facts.drop("lane").alias("s").join(dimension.alias("m"), F.expr("s.key = m.key")).select("s.id", "s.key", "m.number", "m.text")
    assert joined.count() == want.count() > 60_000
    assert joined.exceptAll(want).isEmpty() and want.exceptAll(joined).isEmpty()


def test_no_task_has_over_twice_the_median(spark, facts, dimension):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = {}
        plain = facts.drop("lane").alias("s").join(dimension.hint("merge").alias("m"), F.expr("s.key = m.key"))
        split = join_dimension(facts.drop("lane"), dimension, "key", "key", ["id"])
        for name, df in (("plain", plain), ("split", split)):
            # dimension rows of the hot key double its rows: count facts
            per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("s.id").alias("n"))
            sizes[name] = sorted(r["n"] for r in per_task.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes["split"]) == 8
    assert sizes["split"][-1] <= 2 * sizes["split"][len(sizes["split"]) // 2]
    assert sizes["plain"][-1] > 2 * sizes["plain"][len(sizes["plain"]) // 2]


def test_frequent_keys_are_few(facts):
    found = frequent_keys(facts, "key", 8).collect()
    assert [r["frequent_key"] for r in found] == ["hot"] and found[0]["lanes"] >= 8
    assert frequent_keys(facts.where("false"), "key", 8).isEmpty()


def test_views_do_not_depend_on_the_kind_of_join(spark, sf_dir):
    tables = dict(exports(spark, sf_dir).items())
    doubled = tables["company_map"].union(tables["company_map"].filter("DATAAREAID = 'afr'"))
    for company_map in (tables["company_map"], doubled):
        changed = {**tables, "company_map": company_map}
        small, large = build_views(changed), build_views(changed, max_rows=0)
        for view in VIEWS:
            assert large[view].columns == small[view].columns
            assert large[view].exceptAll(small[view]).isEmpty() and small[view].exceptAll(large[view]).isEmpty()
    rows = check_views(tables, build_views(tables, max_rows=0), [UNMAPPED_COMPANY])
    assert rows.filter("NOT passed").isEmpty()
