"""Checks that read each table once give the same rows as those that look at each part by itself."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybridge import build_views, check_rows, check_views, gate, migrate
from tallybridge.operators.compare import union_all
from tallybridge.plans import reconcile, view_checks
from tallybridge.plans.migration import Migration
from workloads.exports import UNMAPPED_COMPANY, exports
from workloads.extracts import extracts

LEDGER, DETAILS = "CustLedgerEntry_21", "DetailedCustLedgEntry_379"


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("exports")
    found = {}
    for name, df in exports(spark, sf_dir).items():
        df.write.parquet(str(base / name))
        found[name] = spark.read.parquet(str(base / name))
    return found


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("extracts")
    sources = {}
    for name, df in extracts(spark, sf_dir).items():
        df.write.parquet(str(base / name))
        sources[name] = spark.read.parquet(str(base / name))
    return migrate(spark, sources)


def tampered(tables):
    company_map, entries, details = tables["company_map"], tables[LEDGER], tables[DETAILS]
    one = details.filter("`EntryNo-1` % 4 = 1").limit(1)
    null = F.lit(None)
    yield "untouched", {}
    yield "doubled map row", {"company_map": company_map.union(company_map.filter("DATAAREAID = 'afr'"))}
    yield "two codes", {"company_map": company_map.union(company_map.filter("DATAAREAID = 'afr'").withColumn("DATAAREAID", F.lit("xyz")))}
    yield "missing company", {"company_map": company_map.filter("DATAAREAID <> 'eur'")}
    yield "null code", {"company_map": company_map.withColumn("DATAAREAID", F.when(F.col("DATAAREAID") != "eur", F.col("DATAAREAID")))}
    yield "new entry type", {DETAILS: details.union(one.withColumn("EntryType-3", F.lit("Loss")))}
    yield "detail without entry", {DETAILS: details.union(one.withColumn("CustLedgerEntryNo-2", F.lit(-1).cast("bigint")))}
    yield "repeated entries", {LEDGER: entries.union(entries.filter("`EntryNo-1` % 9 = 1"))}
    yield "null numbers", {
        LEDGER: entries.withColumn("EntryNo-1", F.when(F.col("`EntryNo-1`") % 9 != 1, F.col("`EntryNo-1`"))),
        DETAILS: details.withColumn("CustLedgerEntryNo-2", F.when(F.col("`EntryNo-1`") % 7 != 1, F.col("`CustLedgerEntryNo-2`"))),
    }
    yield "null company", {LEDGER: entries.withColumn("$Company", F.when(F.col("`EntryNo-1`") % 9 != 1, F.col("`$Company`")))}
    yield "null flags", {LEDGER: entries.withColumn("Open-36", null.cast("boolean"))}
    yield "no ledger", {"GLEntry_17": tables["GLEntry_17"].filter("false")}
    yield "no details", {DETAILS: details.filter("false")}


def test_view_checks_agree_on_every_tampered_export(tables):
    """The same rows from one scan as from the views themselves, whatever is wrong with the tables."""
    fused, plain = [], []
    for name, change in tampered(tables):
        changed = {**tables, **change}
        fused.append(view_checks.check_exports(changed, [UNMAPPED_COMPANY]).withColumn("case", F.lit(name)))
        plain.append(check_views(changed, build_views(changed), [UNMAPPED_COMPANY]).withColumn("case", F.lit(name)))
    for a, b in zip(fused, plain):
        assert rows_of(a) == rows_of(b)


def test_view_checks_read_each_export_once(tables):
    checks = view_checks.check_exports(tables, [UNMAPPED_COMPANY])
    maps = 2  # the company map also has to be unique
    assert scans(checks) == len(tables) - 1 + maps
    gate(checks)


def test_report_reads_each_side_of_each_entity_once(run):
    checks = check_rows(run)
    assert scans(checks) == 2 * len(run.results)
    gate(checks)


def test_report_agrees_with_the_single_checks(run):
    first = F.col("`Source RecId`") % 97 == 1

    def changed(name, change):
        return Migration(run.spark, run.folder, {**run.results, name: replace(run[name], classified=change(run[name].classified))})

    cases = [
        run,
        changed("open_invoice", lambda df: df.withColumn("Amount", F.when(first, F.col("Amount") + 1).otherwise(F.col("Amount")))),
        changed("open_invoice", lambda df: df.withColumn("Currency Code", F.when(first, "XXX").otherwise(F.col("`Currency Code`")))),
        changed("gl_opening_balance", lambda df: df.filter("`G/L Account No.` <> '320100'")),
        changed("customer", lambda df: df.filter("_source_row % 5 <> 0")),
    ]
    for case in cases:
        got = {(r.entity, r.check): r.passed for r in check_rows(case).collect()}
        totals = {r.entity: r for r in reconcile.key_checksums(case).collect()}
        for r in reconcile.row_accounting(case).collect():
            assert got[r.entity, reconcile.ROW_ACCOUNTING] == r.passed
            assert got[r.entity, reconcile.KEY_CHECKSUM] == totals[r.entity].passed
        for r in reconcile.amount_by_currency(case["open_invoice"]).collect():
            assert got["open_invoice", f"amount total {r.currency} (loaded + rejected)"] == r.passed
        accounts = reconcile.account_totals(case["gl_opening_balance"]).collect()
        assert got["gl_opening_balance", reconcile.ACCOUNT_TOTALS] == all(r.passed for r in accounts)
        assert got["gl_opening_balance", reconcile.TRIAL_BALANCE] == reconcile.trial_balance(case["gl_opening_balance"]).first().passed


def test_nothing_to_check_does_not_pass(spark, run):
    """No account at all proves nothing; neither does an empty list of checks."""
    ledger = run["gl_opening_balance"]
    empty = replace(ledger, source=ledger.source.filter("false"), classified=ledger.classified.filter("false"))
    none = replace(run["open_invoice"], source=run["open_invoice"].source.filter("false"), classified=run["open_invoice"].classified.filter("false"))
    checks = check_rows(Migration(spark, run.folder, {"gl_opening_balance": empty, "open_invoice": none}))
    got = {(r.entity, r.check): (r.source, r.target, r.passed) for r in checks.collect()}
    assert got["gl_opening_balance", reconcile.ACCOUNT_TOTALS] == ("0 accounts", "0 match", False)
    assert got["gl_opening_balance", reconcile.TRIAL_BALANCE] == ("0.00", "0.00", False)
    assert got["open_invoice", reconcile.ROW_ACCOUNTING] == ("0", "0 + 0", True)
    assert len(got) == 6
    assert not reconcile.trial_balance(empty).first().passed
    assert reconcile.summary(checks).first().all_passed is False
    assert tuple(reconcile.summary(checks.filter("false")).first()) == (0, 0, False)


def test_rows_counted_by_the_reader_are_the_source(run):
    vendor = replace(run["vendor"], counted=run["vendor"].source.count() + 3)
    case = Migration(run.spark, run.folder, {**run.results, "vendor": vendor})
    failed = {(r.entity, r.check) for r in check_rows(case).collect() if not r.passed}
    assert failed == {("vendor", reconcile.ROW_ACCOUNTING), ("vendor", reconcile.KEY_CHECKSUM)}
    assert [r.entity for r in reconcile.row_accounting(case).collect() if not r.passed] == ["vendor"]
    assert union_all([reconcile.key_checksums(case, per_bucket=True)]).filter("not passed").isEmpty()
