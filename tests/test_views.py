import pytest
from pyspark.sql import functions as F

from tallybridge import build_views, check_views, create_views, gate
from tallybridge.plans import view_checks, view_reports
from tallybridge.plans.views import VIEWS, broadcast_if_small
from tallybridge.sources.exports import load_tables
from workloads.exports import OVERDUE_BEFORE, UNMAPPED_COMPANY, exports


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {name: df.cache() for name, df in exports(spark, sf_dir).items()}


def failed(tables, expected=(UNMAPPED_COMPANY,)):
    rows = check_views(tables, build_views(tables), expected).collect()
    return {r.check for r in rows if not r.passed}


def test_all_checks_pass(tables):
    rows = check_views(tables, build_views(tables), [UNMAPPED_COMPANY])
    summary = view_checks.check_summary(rows).collect()
    assert len(summary) == 10
    assert all(r.passed for r in summary)
    gate(rows)


def test_columns_and_company_codes(tables):
    view = build_views(tables)["CUSTTRANS"]
    assert {
        "ACCOUNTNUM", "DATAAREAID", "TRANSDATE", "VOUCHER", "AMOUNTCUR", "DIMENSION", "DIMENSION2_",
    } <= set(view.columns)
    codes = {r[0] for r in view.select("DATAAREAID").distinct().collect()}
    assert codes == {"afr", "ame", "asi", "eur"}


def test_open_items_equal_open_flag(tables):
    views = build_views(tables)
    assert view_checks.open_item_differences(tables, views).isEmpty()
    mapped = tables["CustLedgerEntry_21"].join(
        tables["company_map"], F.col("`$Company`") == F.col("CompanyName"), "left_semi"
    )
    flagged = mapped.filter("`Open-36`").select("`EntryNo-1`")
    shown = views["CUSTTRANSOPEN"].select("REFRECID")
    assert shown.exceptAll(flagged).isEmpty() and flagged.exceptAll(shown).isEmpty()


def test_doubled_company_is_caught(tables):
    doubled = tables["company_map"].union(tables["company_map"].filter("DATAAREAID = 'afr'"))
    hits = failed({**tables, "company_map": doubled})
    assert {
        view_checks.MAP_UNIQUE, view_checks.CUSTTRANS_ROWS, view_checks.INITIAL_AMOUNT
    } <= hits


def test_missing_company_is_reported_not_nulled(tables):
    only = {**tables, "company_map": tables["company_map"].filter("DATAAREAID <> 'eur'")}
    views = build_views(only)
    assert {r[0] for r in view_checks.unmapped_companies(views).collect()} == {
        "EUROPE", UNMAPPED_COMPANY,
    }
    for view in VIEWS:
        assert views[view].filter("DATAAREAID IS NULL").isEmpty()
    assert failed(only) == {view_checks.UNMAPPED}
    assert failed(only, ["EUROPE", UNMAPPED_COMPANY]) == set()


def test_null_company_code_is_caught(tables):
    nulled = tables["company_map"].withColumn(
        "DATAAREAID", F.when(F.col("DATAAREAID") != "eur", F.col("DATAAREAID"))
    )
    hits = failed({**tables, "company_map": nulled})
    assert {view_checks.NULL_COMPANY, view_checks.UNMAPPED} <= hits


def test_new_entry_type_is_caught(tables):
    details = tables["DetailedCustLedgEntry_379"]
    extra = details.filter("`EntryNo-1` % 4 = 1").limit(1).withColumn("EntryType-3", F.lit("Loss"))
    hits = failed({**tables, "DetailedCustLedgEntry_379": details.union(extra)})
    assert hits == {view_checks.OPEN_BALANCE}


def test_entry_without_details_shows_zero(tables):
    none = tables["DetailedCustLedgEntry_379"].limit(0)
    view = build_views({**tables, "DetailedCustLedgEntry_379": none})["CUSTTRANS"]
    assert view.filter("AMOUNTCUR <> 0 OR SETTLEAMOUNTCUR <> 0").isEmpty()
    assert view.count() == build_views(tables)["CUSTTRANS"].count()


def test_unreconciled_flag_of_null_open(tables):
    bank = tables["BankAccountLedgerEntry_271"].withColumn("Open-36", F.lit(None).cast("boolean"))
    view = build_views({**tables, "BankAccountLedgerEntry_271": bank})["BANKACCOUNTTRANS"]
    assert {r[0] for r in view.select("RECONCILED").distinct().collect()} == {1}


def test_report_queries(tables):
    views = build_views(tables)
    assert {r[1] for r in views["DQ_UNMAPPED_COMPANIES"].collect()} == {UNMAPPED_COMPANY}
    assert all(abs(r.net) < 0.01 for r in view_reports.ledger_net_by_company(views).collect())
    overdue = view_reports.overdue_by_branch(views, OVERDUE_BEFORE).collect()
    assert overdue and all(r.overdue_amount > 0 for r in overdue)
    amounts = [r.overdue_amount for r in overdue]
    assert amounts == sorted(amounts, reverse=True)


def test_float_amounts(tables):
    """Exports that hold amounts as floating point numbers reconcile within the tolerance."""
    amounts = {
        "DetailedCustLedgEntry_379": "Amount-7",
        "BankAccountLedgerEntry_271": "Amount-13",
        "GLEntry_17": "Amount-17",
    }
    floats = {
        t: tables[t].withColumn(c, F.col(f"`{c}`").cast("double")) for t, c in amounts.items()
    }
    assert failed({**tables, **floats}) == set()


def test_company_map_made_from_python_rows_is_broadcast(spark, tables):
    """Spark does not know the size of such a map; it is counted and broadcast."""
    rows = [tuple(r) for r in tables["company_map"].collect()]
    made = spark.createDataFrame(rows, "CompanyName string, DATAAREAID string")
    view = build_views({**tables, "company_map": made})["LEDGERTRANS"]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_company_map_is_joined_by_shuffle(spark, tables):
    large = broadcast_if_small(tables["company_map"], max_rows=2)
    assert "hint" not in large._jdf.queryExecution().logical().toString().lower()
    small = broadcast_if_small(tables["company_map"], max_rows=4)
    assert "hint" in small._jdf.queryExecution().logical().toString().lower()


def test_created_views_equal_the_dataframe_views(spark, tables):
    buckets = {
        "CustLedgerEntry_21": (4, ["EntryNo-1", "$Company"]),
        "DetailedCustLedgEntry_379": (4, ["CustLedgerEntryNo-2", "$Company"]),
    }
    names = load_tables(spark, tables, "dbo", buckets=buckets)
    assert "dbo.CustLedgerEntry_21" in names
    for _ in range(2):
        created = create_views(spark, "ax", "dbo")
    views = build_views(tables)
    assert len(created) == 6
    for name in created:
        left, right = spark.table(name), views[name.split(".")[1]]
        assert left.columns == right.columns
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_bucketed_tables_meet_without_a_shuffle(spark, tables):
    """Runs on the tables loaded above: details are summed and joined where they lie."""
    loaded = {n: spark.table(f"dbo.{n}") for n in tables}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plan = build_views(loaded)["CUSTTRANS"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_open_items_of_two_companies_share_numbers(spark):
    """Entry 1 is open in both companies and shown for one of them only."""
    tables = {
        "company_map": spark.createDataFrame([("A", "a"), ("B", "b")], "CompanyName string, DATAAREAID string"),
        "CustLedgerEntry_21": spark.createDataFrame(
            [("A", 1, True), ("B", 1, True), ("B", 2, False)],
            "`$Company` string, `EntryNo-1` bigint, `Open-36` boolean",
        ),
    }
    shown = {"CUSTTRANSOPEN": spark.createDataFrame([("a", 1), ("b", 2)], "DATAAREAID string, REFRECID bigint")}
    found = {tuple(r) for r in view_checks.open_item_differences(tables, shown).collect()}
    assert found == {("b", 1, 0, 1), ("b", 2, 1, 0)}


def test_overdue_report_reads_the_ledger_once(tables):
    plan = view_reports.overdue_by_branch(build_views(tables), OVERDUE_BEFORE)
    optimised = plan._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in optimised.splitlines() if "InMemoryRelation" in line]
    assert sum("DueDate-37" in line for line in scans) == 1
    assert sum("CustLedgerEntryNo-2" in line for line in scans) == 1
