"""Profiles of parts, merged, against the profile of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from tallybridge.functions.rules import WHITESPACE, trim
from tallybridge.operators import profile_store as P
from tallybridge.operators.profile import column_metrics
from workloads.extracts import extracts

EXACT = ["table", "column", "n_rows", "null_pct", "smallest", "largest", "n_spaces", "mixed_case", "n_bad_email", "n_numbers"]


def exact(stored):
    return sorted(map(repr, P.read_profile(stored).select(EXACT).collect()))


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(5)
    rows = [(i, f"{rng.gauss(100, 30):.2f}" if i % 9 else None, rng.choice(["a", "B ", "c"]), f"u{i % 7000}@x.org" if i % 5 else "bad") for i in range(20_000)]
    return spark.createDataFrame(rows, "_source_row long, AMOUNT string, CUSTGROUP string, EMAIL string").repartition(6)


def test_merged_equals_whole(numbers):
    parts = [numbers.where(F.col("_source_row") % 3 == k) for k in range(3)]
    merged = P.merge_profiles([P.stored_profile(p, "T") for p in parts])
    whole = P.stored_profile(numbers, "T")
    assert exact(merged) == exact(whole)
    pairwise = P.merge_profiles([P.merge_profiles([P.stored_profile(p, "T") for p in parts[:2]]), P.stored_profile(parts[2], "T")])
    assert exact(pairwise) == exact(whole)
    truth = numbers.agg(*[F.count_distinct(c).alias(c) for c in ("AMOUNT", "CUSTGROUP", "EMAIL")]).first()
    for row in P.read_profile(merged).collect():
        assert abs(row.n_distinct - truth[row.column]) <= P.DISTINCT_ERROR * truth[row.column]
    amounts = sorted(float(r[0]) for r in numbers.where("AMOUNT IS NOT NULL").select("AMOUNT").collect())
    row = P.read_profile(merged).where("column = 'AMOUNT'").first()
    for q in P.QUANTILES:
        low, high = (amounts[int((q + d) * len(amounts))] for d in (-P.RANK_ERROR, P.RANK_ERROR))
        assert low <= row[f"q{round(100 * q)}"] <= high
    assert row.n_numbers == len(amounts)


def test_stored_and_read_again(spark, numbers, tmp_path):
    """Yesterday's profile is read from its file; only today's rows are scanned."""
    P.stored_profile(numbers.where("_source_row < 12000"), "T").write.parquet(str(tmp_path / "p"))
    merged = P.merge_profiles([spark.read.parquet(str(tmp_path / "p")), P.stored_profile(numbers.where("_source_row >= 12000"), "T")])
    assert exact(merged) == exact(P.stored_profile(numbers, "T"))


def test_agrees_with_the_exact_profile(spark, sf_dir):
    for name, df in extracts(spark, sf_dir).items():
        known = {r["column"]: r for r in column_metrics(df, name).collect()}
        for r in P.read_profile(P.stored_profile(df, name)).collect():
            k = known[r["column"]]
            assert (r.n_rows, r.n_spaces, r.mixed_case, r.n_bad_email) == (k.n_rows, k.n_spaces, k.mixed_case, k.n_bad_email)
            assert abs(r.n_distinct - k.n_distinct) <= P.DISTINCT_ERROR * k.n_distinct


def test_empty_parts_and_new_columns(spark, numbers):
    empty = P.stored_profile(numbers.where("false"), "T")
    assert empty.count() == 3
    whole = P.stored_profile(numbers, "T")
    assert exact(P.merge_profiles([empty, whole])) == exact(whole)
    assert {(r.n_rows, r.null_pct, r.n_distinct, r.q50) for r in P.read_profile(empty).collect()} == {(0, None, 0, None)}
    newer = numbers.limit(100).withColumn("CITY", F.lit("Rome"))
    row = P.read_profile(P.merge_profiles([whole, P.stored_profile(newer, "T")])).where("column = 'CITY'").first()
    assert (row.n_rows, row.n_distinct, row.null_pct) == (20_100, 1, 99.5)


def test_no_value_is_shuffled(numbers):
    plan = P.stored_profile(numbers, "T")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1


def test_a_number_is_read_once(numbers):
    """Each value is cast once, behind a pattern: a cast that fails raises an exception inside."""
    plan = P.stored_profile(numbers, "T")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double") == plan.count("CASE WHEN RLIKE(value_") == 3


def test_numbers_and_spaces_of_odd_texts(spark):
    heads, tails = ["", "+", "-", " ", "\t-", "\x00", "\xa0", "e", "$", "+-"], ["", "d", "F", " ", "\n", "\x1f ", "\u2003", "x", "L", "%"]
    bodies = "1 1. .5 . 1.2.3 007 1e5 1E-5 1e+400 1e 0x1p3 0X.8P-2f 0x10 1,000 1_0 NaN nan NAN inf Inf -inf infinity INFINITY infinit \u0661 \uff11 C7 IT-1".split()
    texts = {h + b + t for h in heads for b in [*bodies, "", "1 2"] for t in tails} | set(WHITESPACE) | {f"a{w}b" for w in WHITESPACE} | {None, "\u200b1", "a\n\nb\n"}
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    v = F.col("v")
    number, spaces = P._number(v), P._has_spaces(v)
    wrong = rows.where(~number.eqNullSafe(v.try_cast("double")) | ~spaces.eqNullSafe(v != trim(v)))
    assert wrong.collect() == [] and rows.where(number.isNotNull()).count() > 300
