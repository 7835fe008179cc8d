"""Profiles against a pandas restatement on a small table."""

import pandas as pd
import pytest

from tallybridge import profile_columns, profile_issues, profile_tables
from tallybridge.operators.profile import approximate_columns, duplicate_keys

ROWS = [
    (3, "c1 ", "DOM", "a@b.com", "INR"),
    (1, None, "dom ", "bad", None),
    (0, None, "DOM", None, None),
    (2, "C1", None, " a@b.com", "USD"),
    (4, None, "EXP", "bad", "INR"),
    (5, "\tc2", "EXP", "x@y.org", "INR"),
    (6, "c3", "EXP", "x@y.org", "INR"),
    (7, "c3", "EXP", "x@y.org", "INR"),
]
COLUMNS = ["ACCOUNTNUM", "CUSTGROUP", "EMAIL", "CURRENCY"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        ROWS, "_source_row bigint, " + ", ".join(f"{c} string" for c in COLUMNS)
    ).repartition(3)


def test_columns(table):
    frame = pd.DataFrame(ROWS, columns=["_source_row", *COLUMNS]).sort_values("_source_row")
    got = {r["column"]: r for r in profile_columns(table, "T").collect()}
    assert list(got) and set(got) == set(COLUMNS)
    for c in COLUMNS:
        s = frame[c]
        text = s.dropna()
        assert got[c]["null_pct"] == round(100 * s.isna().mean(), 1)
        assert got[c]["n_distinct"] == s.nunique()
        assert got[c]["sample"] == text.iloc[0]
    assert got["ACCOUNTNUM"]["flags"] == "2 with leading/trailing spaces"
    assert got["CUSTGROUP"]["flags"] == "1 with leading/trailing spaces; mixed case codes"
    assert got["EMAIL"]["flags"] == "1 with leading/trailing spaces; 3 invalid e-mails"
    assert got["CURRENCY"]["flags"] == ""


def test_half_percentages_round_to_even(spark):
    df = spark.range(400).selectExpr("id AS _source_row", "IF(id < 5, NULL, 'x') AS A")
    assert profile_columns(df, "T").first()["null_pct"] == 1.2


def test_issues(table):
    got = {(r["column"], r["issue"], r["n"]) for r in profile_issues(table, "T", "ACCOUNTNUM").collect()}
    assert got == {
        ("ACCOUNTNUM", "with leading/trailing spaces", 2),
        ("CUSTGROUP", "with leading/trailing spaces", 1),
        ("CUSTGROUP", "mixed case codes", None),
        ("EMAIL", "with leading/trailing spaces", 1),
        ("EMAIL", "invalid e-mails", 3),
        ("CURRENCY", "missing values", 2),
        # C1 twice, c3 twice, and three null keys that count as one key
        ("ACCOUNTNUM", "duplicate keys after trim/upper", 4),
    }


def test_empty_column_and_empty_table(spark):
    df = spark.createDataFrame([(0, None)], "_source_row bigint, A string")
    row = profile_columns(df, "T").first()
    assert (row["null_pct"], row["n_distinct"], row["sample"], row["flags"]) == (100.0, 0, "", "")
    assert duplicate_keys(df.limit(0), "T", "A").first()["n"] == 0


def test_estimates_are_close(table):
    got = {r["column"]: r["n_distinct"] for r in approximate_columns(table, "T").collect()}
    assert got == {"ACCOUNTNUM": 4, "CUSTGROUP": 3, "EMAIL": 4, "CURRENCY": 2}


def test_all_tables(table):
    got = profile_tables({"B": table, "A": table}, keys={"A": "ACCOUNTNUM"}).collect()
    assert len([r for r in got if r["table"] == "A"]) == 7
    assert len([r for r in got if r["table"] == "B"]) == 6


def test_empty_table_has_a_row_for_each_column(table):
    empty = table.filter("false")
    rows = profile_columns(empty, "T").orderBy("position").collect()
    assert [(r["column"], r.null_pct, r.n_distinct, r["sample"], r.flags) for r in rows] == [
        (c, None, 0, "", "") for c in COLUMNS
    ]
    assert profile_issues(empty, "T", "ACCOUNTNUM").isEmpty()


def test_duplicate_keys_come_from_the_value_counts(table):
    issues = profile_issues(table, "T", "ACCOUNTNUM").filter("issue like 'duplicate%'").first()
    assert issues["n"] == duplicate_keys(table, "T", "ACCOUNTNUM").first()["n"] > 0
