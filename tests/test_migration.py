"""A whole migration over the derived extracts: accounting, reasons, checks and mutations."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybridge import CheckFailed, check_rows, gate, load_spec, migrate, parse_spec
from tallybridge.operators.checksum import differing_keys, key_digest
from tallybridge.operators.quarantine import classify
from tallybridge.plans import reconcile
from tallybridge.plans.migration import EntityResult, Migration
from workloads.extracts import extracts


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return migrate(spark, extracts(spark, sf_dir))


def tampered(run, name, change):
    """The run with the written table of one entity changed."""
    result = run[name]
    results = {**run.results, name: replace(result, classified=change(result.classified))}
    return Migration(run.spark, run.folder, results)


def failed(run):
    return {(r.entity, r.check) for r in check_rows(run).collect() if not r.passed}


def test_every_source_row_is_accounted_for(run):
    for result in run.results.values():
        assert result.loaded.count() + result.rejects.count() == result.source.count()


def test_all_checks_pass(run):
    rows = check_rows(run).collect()
    assert len(rows) == 15
    assert all(r.passed for r in rows)
    gate(check_rows(run))
    assert tuple(reconcile.summary(check_rows(run)).first()) == (15, 15, True)


def test_planted_defects_carry_their_reason(run):
    counts = {
        (r["entity"], r["reject_reason"]): r["rows"] for r in reconcile.reject_summary(run).collect()
    }
    assert counts == {
        ("customer", "duplicate_after_normalisation"): 3,
        ("customer", "missing_required:Name"): 2,
        ("customer", "missing_required:Customer Posting Group"): 1,
        ("open_invoice", "orphan:Customer No."): 31,
    }
    assert run["customer"].loaded.count() == 147
    assert run["open_invoice"].loaded.count() == 1469


def test_invoice_amounts_of_both_sides(run):
    loaded = run["open_invoice"].loaded.agg(F.sum("Amount")).first()[0]
    value = reconcile.reject_value(run["open_invoice"]).first()
    assert str(loaded) == "366724532.45"
    assert str(value["amount"]) == "7722259.16"


def test_target_keys_are_unique_and_clean(run):
    keys = [r[0] for r in run["customer"].loaded.select("`No.`").collect()]
    assert len(keys) == len(set(keys))
    assert all(k == k.strip().upper() for k in keys)


def test_local_currency_is_blank(run):
    codes = {r[0] for r in run["customer"].loaded.select("`Currency Code`").distinct().collect()}
    assert codes == {"", "USD", "AED"}


def test_invoices_of_rejected_customers_are_orphans(run):
    customers = run["customer"].loaded.select("`No.`")
    stray = run["open_invoice"].loaded.join(
        customers, F.col("`Customer No.`") == F.col("`No.`"), "left_anti"
    )
    assert stray.isEmpty()


def test_changed_amount_is_detected(run):
    first = run["open_invoice"].loaded.agg(F.min(F.col("`Source RecId`"))).first()[0]
    bad = tampered(
        run,
        "open_invoice",
        lambda df: df.withColumn(
            "Amount",
            F.when(F.col("`Source RecId`") == first, F.col("Amount") + 1).otherwise(F.col("Amount")),
        ),
    )
    (hit,) = failed(bad)
    assert hit[0] == "open_invoice" and hit[1].startswith("amount total")
    with pytest.raises(CheckFailed):
        gate(check_rows(bad))


def test_dropped_row_is_detected(run):
    bad = tampered(run, "vendor", lambda df: df.filter(F.col("_source_row") != 0))
    assert failed(bad) == {
        ("vendor", reconcile.ROW_ACCOUNTING),
        ("vendor", reconcile.KEY_CHECKSUM),
    }


def test_changed_key_is_detected_and_located(run):
    bad = tampered(
        run,
        "vendor",
        lambda df: df.withColumn(
            "No.", F.when(F.col("_source_row") == 0, "V0").otherwise(F.col("`No.`"))
        ),
    )
    assert failed(bad) == {("vendor", reconcile.KEY_CHECKSUM)}
    only = Migration(bad.spark, bad.folder, {"vendor": bad["vendor"]})
    buckets = reconcile.key_checksums(only, per_bucket=True).filter(~F.col("passed"))
    source, target = reconcile.source_keys(bad["vendor"]), reconcile.target_keys(bad["vendor"])
    found = {(r[0], r[1]) for r in differing_keys(source, target, buckets).collect()}
    assert found == {("V000000000000", 1), ("V0", -1)}


def test_lost_and_doubled_key_is_detected(run):
    bad = tampered(
        run,
        "vendor",
        lambda df: df.filter(F.col("_source_row") != 0).union(df.filter(F.col("_source_row") == 1)),
    )
    assert failed(bad) == {("vendor", reconcile.KEY_CHECKSUM)}


def test_changed_quarantine_key_is_detected(run):
    bad = tampered(
        run,
        "customer",
        lambda df: df.withColumn(
            "_source", F.col("_source").withField("ACCOUNTNUM", F.lit("lost"))
        ),
    )
    assert failed(bad) == {("customer", reconcile.KEY_CHECKSUM)}


def test_missing_account_fails_instead_of_raising(run):
    bad = tampered(
        run, "gl_opening_balance", lambda df: df.filter(F.col("`G/L Account No.`") != "410100")
    )
    assert failed(bad) == {
        ("gl_opening_balance", reconcile.ROW_ACCOUNTING),
        ("gl_opening_balance", reconcile.KEY_CHECKSUM),
        ("gl_opening_balance", reconcile.ACCOUNT_TOTALS),
        ("gl_opening_balance", reconcile.TRIAL_BALANCE),
    }


def test_suspense_account(run):
    result = run["gl_opening_balance"]
    assert not reconcile.trial_balance(result, accounts=["320100"]).first().passed
    empty = reconcile.trial_balance(result, accounts=["999999"]).first()
    assert not empty.passed and empty.loaded_net == 0


def test_currency_seen_only_in_the_target_fails(run):
    bad = tampered(
        run,
        "open_invoice",
        lambda df: df.withColumn(
            "Currency Code",
            F.when(F.col("`Currency Code`") == "USD", "XXX").otherwise(F.col("`Currency Code`")),
        ),
    )
    hits = {check.split()[2] for _, check in failed(bad)}
    assert {"USD", "XXX"} <= hits


def test_supplier_invoices_reconcile_by_currency_too(spark, run):
    """The currency check takes any entity: here open supplier invoices."""
    spec = {
        **{"vendor": load_spec()["vendor"]},
        **parse_spec(
            {
                "payable": {
                    "source": "VENDTRANSOPEN",
                    "key": {"source": "RECID", "target": "Id"},
                    "fields": {
                        "Id": {"from": "RECID"},
                        "Value": {"from": "AMOUNTCUR", "rules": ["to_decimal"]},
                        "Currency Code": {
                            "from": "CURRENCYCODE", "rules": ["trim", "upper", "lcy_blank"]
                        },
                    },
                    "required": ["Value"],
                }
            }
        ),
    }
    rows = [(0, "1", "10.00", "usd "), (1, "2", "5.50", None), (2, "3", None, "USD")]
    source = spark.createDataFrame(
        rows, "_source_row bigint, RECID string, AMOUNTCUR string, CURRENCYCODE string"
    )
    done = migrate(spark, {"VENDTRANSOPEN": source}, spec, entities=["payable"])
    got = {
        r.currency: (str(r.source_amount), str(r.loaded_amount), r.passed)
        for r in reconcile.amount_by_currency(done["payable"], "Value").collect()
    }
    assert got == {"USD": ("10.00", "10.00", True), "LCY": ("5.50", "5.50", True)}


def test_unreadable_numbers(spark):
    rows = [(0, "1", "C1", "i", "2024-01-01", "12,5", None), (1, "x", "C1", "i", "d", "3", None)]
    source = spark.createDataFrame(
        rows,
        "_source_row bigint, RECID string, ACCOUNTNUM string, INVOICE string, TRANSDATE string, "
        "AMOUNTCUR string, CURRENCYCODE string",
    )
    customers = spark.createDataFrame(
        [(0, "c1 ", "N", "DOM", None, None, None, "oops", "0")],
        "_source_row bigint, ACCOUNTNUM string, NAME string, CUSTGROUP string, CURRENCY string, "
        "EMAIL string, CITY string, CREDITMAX string, BLOCKED string",
    )
    sources = {"CUSTTRANSOPEN": source, "CUSTTABLE": customers}
    done = migrate(spark, sources, entities=["customer", "open_invoice"])
    assert [r.reject_reason for r in done["customer"].rejects.collect()] == [
        "invalid_number:Credit Limit (LCY)"
    ]
    reasons = {r.RECID: r.reject_reason for r in done["open_invoice"].rejects.collect()}
    # A number that cannot be read is told from a missing one, and named before anything else.
    assert reasons == {"1": "invalid_number:Amount", "x": "invalid_number:Source RecId"}
    for name in ("customer", "open_invoice"):
        with pytest.raises(ValueError, match="unreadable"):
            migrate(spark, sources, entities=[name], run=Migration(spark, done.folder + "-strict", {"customer": done["customer"]}), strict=True)


def invoices(spark, *amounts):
    rows = [(i, f"x{i}", "C1", "i", "d", a, "USD") for i, a in enumerate(amounts)]
    return spark.createDataFrame(
        rows,
        "_source_row bigint, RECID string, ACCOUNTNUM string, INVOICE string, TRANSDATE string, "
        "AMOUNTCUR string, CURRENCYCODE string",
    )


def test_unreadable_amounts_do_not_pass_as_nothing(spark):
    spec = load_spec()["open_invoice"]
    parents = {"customer": (spark.createDataFrame([("C1",)], "`No.` string"), "No.")}
    source = invoices(spark, "12,500.00", "10.00", "   ", None, "").withColumn("RECID", F.col("_source_row").cast("string"))
    result = EntityResult(spec, source, classify(spec, source, parents))
    total = reconcile.amount_by_currency(result).first()
    assert (str(total.source_amount), str(total.loaded_amount), total.source_unreadable, total.rejected_unreadable) == ("10.00", "10.00", 2, 2)
    assert not total.passed
    value = {r.reject_reason: (r.rows, r.unreadable) for r in reconcile.reject_value(result).collect()}
    assert value == {"invalid_number:Amount": (2, 2), "missing_required:Amount": (2, 0)}


def test_changed_unreadable_key_is_detected(spark):
    spec = load_spec()["open_invoice"]
    parents = {"customer": (spark.createDataFrame([("C1",)], "`No.` string"), "No.")}
    source = invoices(spark, "1.00", "2.00")
    rows = classify(spec, source, parents)
    run = Migration(spark, "", {"open_invoice": EntityResult(spec, source, rows)})
    assert reconcile.key_checksums(run).first().passed
    other = source.withColumn("RECID", F.concat("RECID", F.lit("?")))
    run = Migration(spark, "", {"open_invoice": EntityResult(spec, other, rows)})
    assert not reconcile.key_checksums(run).first().passed


def test_missing_key_equals_no_text(spark):
    keys = [None, "", "<null>", "\x02", "\x01"]
    for n in (1, 2):
        df = spark.createDataFrame([(k, k) for k in keys], "a string, b string")
        assert df.select(key_digest([F.col("a"), F.col("b")][:n])).distinct().count() == len(keys)


def test_gate_needs_checks(run):
    checks = check_rows(run)
    with pytest.raises(CheckFailed, match="no check"):
        gate(checks.filter("false"))
    gate(checks.filter("false"), allow_empty=True)
    many = checks.sparkSession.range(250).select(F.lit(False).alias("passed"))
    with pytest.raises(CheckFailed, match="250 of 250"):
        gate(many)


def test_audit_sample_is_repeatable(run):
    first = reconcile.audit_sample(run["customer"]).collect()
    assert len(first) == 25
    assert first == reconcile.audit_sample(run["customer"]).collect()


def test_result_type(run):
    assert isinstance(run["customer"], EntityResult)
