"""Registered queries: every operator over the given tables.

A query is a function (spark, sf_dir) -> DataFrame. Money leaves as double and field names as plain
words, so that results compare across engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge import sinks
from tallybridge.functions import rules
from tallybridge.operators import changes, profile, profile_store
from tallybridge.operators.compare import union_all
from tallybridge.operators.quarantine import (
    REASON,
    SOURCE_ROW,
    classify,
    loaded_rows,
    mark_duplicates,
    missing_required,
    rejected_rows,
)
from tallybridge.plans import reconcile, view_checks, view_reports, views
from tallybridge.plans.migration import EntityResult, Migration, migrate
from tallybridge.plans.spec import check_source, col, load_spec, parse_spec
from tallybridge.session import materialise, new_folder, run_jobs
from tallybridge.sources import exports as export_source
from tallybridge.sources.extracts import NULL_TOKENS, land_folder, landing_counts, read_extract
from workloads.exports import (
    EXPORTS,
    OVERDUE_BEFORE,
    UNMAPPED_COMPANY,
    company_map,
    export,
    exports,
)
from workloads.extracts import (
    PAYABLE_EXTRACT,
    PAYABLE_SPEC,
    UNREADABLE_AMOUNT,
    extract,
    extracts,
    read_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Field names in lower case words; decimals as double, wide integers as bigint."""
    cells = []
    for field in df.schema.fields:
        name = re.sub(r"[^0-9A-Za-z]+", "_", field.name).strip("_").lower()
        cell = col(field.name)
        if field.dataType.typeName() == "decimal":
            cell = cell.cast("double")
        cells.append(cell.alias(name))
    return df.select(*cells)


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as double, names unchanged."""
    return df.select(
        *[
            (col(f.name).cast("double") if f.dataType.typeName() == "decimal" else col(f.name)).alias(
                f.name
            )
            for f in df.schema.fields
        ]
    )


# --- cleansing rules ------------------------------------------------------------------------


def _rule_query(name: str, table: str, **outputs) -> None:
    """Query ``name``: the output columns (functions of nothing -> Column) over an extract."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return doubles(
            extract(spark, sf_dir, table).select(
                F.col(SOURCE_ROW).alias("source_row"), *[fn().alias(c) for c, fn in outputs.items()]
            )
        )

    QUERIES[name] = run


def _rules(column: str, *names: str):
    return lambda: rules.apply_rules(F.col(column), names)


_rule_query(
    "rule_trim", "CUSTTABLE",
    account=_rules("ACCOUNTNUM", "trim"),
    custgroup=_rules("CUSTGROUP", "trim"),
    city=_rules("CITY", "trim"),
)
_rule_query(
    "rule_upper", "CUSTTABLE",
    account=_rules("ACCOUNTNUM", "upper"),
    custgroup=_rules("CUSTGROUP", "upper"),
)
_rule_query(
    "rule_lower", "CUSTTABLE", account=_rules("ACCOUNTNUM", "lower"), email=_rules("EMAIL", "lower")
)
_LONG = "concat_ws(' ', ACCOUNTNUM, NAME, EMAIL, CITY, ACCOUNTNUM, NAME, EMAIL, CITY)"
_rule_query(
    "rule_truncate", "CUSTTABLE",
    short=lambda: rules.apply_rules(F.expr(_LONG), ["truncate_30"]),
    long=lambda: rules.apply_rules(F.expr(_LONG), ["truncate_100"]),
)
_DIRTY_PRICE = (
    "CASE WHEN _source_row%91=4 THEN 'n/k' WHEN _source_row%91=5 THEN concat(' ', PRICE, ' ') "
    "ELSE PRICE END"
)
_rule_query(
    "rule_to_decimal", "INVENTTABLE",
    raw=lambda: F.expr(_DIRTY_PRICE),
    price=lambda: rules.apply_rules(F.expr(_DIRTY_PRICE), ["to_decimal"]),
)
_rule_query(
    "rule_lcy_blank", "CUSTTRANSOPEN",
    raw=lambda: F.col("CURRENCYCODE"),
    currency=_rules("CURRENCYCODE", "lcy_blank"),
)
_rule_query(
    "rule_valid_email", "CUSTTABLE",
    email=_rules("EMAIL", "valid_email_or_blank"),
    lowered=_rules("EMAIL", "trim", "lower", "valid_email_or_blank"),
)
_rule_query(
    "rule_map_posting_group", "CUSTTABLE",
    raw_code=_rules("CUSTGROUP", "map_posting_group"),
    clean_code=_rules("CUSTGROUP", "trim", "upper", "map_posting_group"),
)
_rule_query(
    "rule_map_blocked", "CUSTTABLE",
    blocked=_rules("BLOCKED", "map_blocked"),
    other=lambda: rules.map_blocked(F.expr("CAST(_source_row%5 AS STRING)")),
)
_rule_query("rule_default_pcs", "INVENTTABLE", unit=_rules("UNITID", "trim", "upper", "default_pcs"))
_rule_query(
    "rule_chain", "CUSTTABLE",
    account=_rules("ACCOUNTNUM", "trim", "upper"),
    posting_group=_rules("CUSTGROUP", "trim", "upper", "map_posting_group"),
    currency=_rules("CURRENCY", "trim", "upper", "lcy_blank"),
    email=_rules("EMAIL", "trim", "lower", "valid_email_or_blank"),
    credit_limit=_rules("CREDITMAX", "to_decimal"),
)


@query("custom_rule")
def custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule added by the user takes part in a chain like the shipped ones."""
    rules.register_rule("last_six", lambda c: F.right(c, F.lit(6)))
    return extract(spark, sf_dir, "VENDTABLE").select(
        F.col(SOURCE_ROW).alias("source_row"),
        rules.apply_rules(F.col("ACCOUNTNUM"), ["trim", "last_six"]).alias("short_account"),
    )


# --- mapping, quarantine ---------------------------------------------------------------------

ENTITY_KEYS = {
    "customer": "customer",
    "vendor": "vendor",
    "item": "item",
    "open_invoice": "open_invoice",
    "gl": "gl_opening_balance",
}


def _map_query(key: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        entity = load_spec()[name]
        source = extract(spark, sf_dir, entity.source)
        return plain(source.select(F.col(SOURCE_ROW).alias("source_row"), *entity.mapped()))

    QUERIES[key] = run


for _key, _name in (
    ("map_customer", "customer"),
    ("map_vendor", "vendor"),
    ("map_item", "item"),
    ("map_open_invoice", "open_invoice"),
    ("map_gl_opening", "gl_opening_balance"),
):
    _map_query(_key, _name)


@query("spec_coverage")
def spec_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded spec over all extracts: for each mapped field its source, and how many rows have a value before and after."""
    parts = []
    for name, entity in load_spec().items():
        source = extract(spark, sf_dir, entity.source)
        check_source(entity, source.columns)
        counts = source.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(col(f.source)).alias(f"before_{i}") for i, f in enumerate(entity.fields)],
            *[F.count(f.value()).alias(f"after_{i}") for i, f in enumerate(entity.fields)],
        )
        cells = [
            F.struct(
                F.lit(f.target).alias("target"), F.lit(f.source).alias("source"),
                F.col(f"before_{i}").alias("before"), F.col(f"after_{i}").alias("after"),
            )
            for i, f in enumerate(entity.fields)
        ]
        parts.append(counts.select(F.lit(name).alias("entity"), "rows", F.explode(F.array(*cells)).alias("c")).select("entity", "rows", "c.*"))
    return union_all(parts)


def _classified(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One entity with its parents, as one lazy plan on top of the extracts."""
    spec = load_spec()
    entity = spec[name]
    parents = {
        parent: (
            loaded_rows(_classified(spark, sf_dir, parent), spec[parent]),
            spec[parent].key_target[0],
        )
        for _, parent in entity.foreign_keys
    }
    return classify(entity, extract(spark, sf_dir, entity.source), parents)


def _quarantine_query(key: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _classified(spark, sf_dir, name)
        return plain(
            rows.select(
                F.col(SOURCE_ROW).alias("source_row"),
                *[col(k) for k in load_spec()[name].key_target],
                F.col("status"),
                F.coalesce(REASON, F.lit("")).alias(REASON),
            )
        )

    QUERIES[f"quarantine_{key}"] = run


for _key, _name in ENTITY_KEYS.items():
    _quarantine_query(_key, _name)


def _with_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open invoices of which some have an amount that is no number: grouped digits, or blanks."""
    return extract(spark, sf_dir, "CUSTTRANSOPEN").withColumn("AMOUNTCUR", F.expr(UNREADABLE_AMOUNT))


def _unreadable_run(spark: SparkSession, sf_dir: str) -> EntityResult:
    spec = load_spec()
    source = _with_unreadable(spark, sf_dir)
    customers = loaded_rows(_classified(spark, sf_dir, "customer"), spec["customer"])
    parents = {"customer": (customers, spec["customer"].key_target[0])}
    rows = classify(spec["open_invoice"], source, parents)
    return EntityResult(spec["open_invoice"], source, rows)


@query("quarantine_unreadable")
def quarantine_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with unreadable amounts are told from invoices without one."""
    rows = _unreadable_run(spark, sf_dir).classified
    return rows.select(
        F.col(SOURCE_ROW).alias("source_row"), "status", F.coalesce(REASON, F.lit("")).alias(REASON)
    )


@query("quarantine_ordered")
def quarantine_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose order is that of a mapped column; rejects keep it."""
    entity = load_spec()["customer"]
    source = extract(spark, sf_dir, entity.source).drop(SOURCE_ROW)
    return rejected_rows(classify(entity, source, order_by=["ACCOUNTNUM"])).select(
        "ACCOUNTNUM", "NAME", REASON
    )


@query("quarantine_required")
def quarantine_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First missing required field of every customer row."""
    entity = load_spec()["customer"]
    rows = extract(spark, sf_dir, entity.source).select(SOURCE_ROW, *entity.mapped())
    return rows.select(
        F.col(SOURCE_ROW).alias("source_row"),
        F.coalesce(missing_required(entity.required), F.lit("")).alias(REASON),
    )


@query("quarantine_duplicates")
def quarantine_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated order lines: all but the first by the other columns; full copies by file position."""
    lines = read_table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    rest = [c for c in lines.columns if c not in key]
    placed = lines.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    return mark_duplicates(placed, key, [*rest, "file", "at"]).drop("file", "at")


@query("quarantine_precedence")
def quarantine_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of customer rows with one key: the reason of each, a rejected first included."""
    rows = _classified(spark, sf_dir, "customer").select(
        F.col("`No.`").alias("no"),
        F.when(F.col(SOURCE_ROW) >= 10**15, "copy").otherwise("first").alias("which"),
        F.coalesce(REASON, F.lit("")).alias(REASON),
    )
    return rows.groupBy("which", REASON).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("no").alias("first_no"), F.max("no").alias("last_no")
    )


@query("loaded_customer")
def loaded_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(loaded_rows(_classified(spark, sf_dir, "customer"), load_spec()["customer"]))


@query("rejects_customer")
def rejects_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(_classified(spark, sf_dir, "customer"))


# --- reconciliation of the migration ---------------------------------------------------------

_RUNS: dict[tuple[str, str], Migration] = {}


def migrated(spark: SparkSession, sf_dir: str, *names: str) -> Migration:
    """The written migration of the named entities (all by default).

    A migration is run once per session and folder; every check reads what it wrote.
    """
    spec = load_spec()
    names = names or tuple(spec)
    key = (spark.sparkContext.applicationId, sf_dir)
    run = _RUNS.get(key)
    if run is None:
        run = _RUNS[key] = Migration(spark, new_folder(spark, "migration"))
    wanted = {*names, *(p for n in names for _, p in spec[n].foreign_keys)}
    missing = [n for n in spec if n in wanted and n not in run.results]
    if missing:
        migrate(spark, extracts(spark, sf_dir), run=run, entities=missing)
    return Migration(spark, run.folder, {n: run[n] for n in spec if n in names})


@query("entity_summary")
def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.entity_summary(migrated(spark, sf_dir))


@query("missing_currency_warnings")
def missing_currency_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = load_spec()
    return union_all(
        [
            reconcile.missing_currency(e, extract(spark, sf_dir, e.source))
            for e in spec.values()
        ]
    )


@query("reject_summary")
def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reject_summary(migrated(spark, sf_dir))


@query("reject_value")
def reject_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(reconcile.reject_value(migrated(spark, sf_dir, "open_invoice")["open_invoice"]))


@query("reject_value_unreadable")
def reject_value_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(reconcile.reject_value(_unreadable_run(spark, sf_dir)))


@query("recon_unreadable_amounts")
def recon_unreadable_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per currency over unreadable amounts: counted on both sides, and not passed."""
    return doubles(reconcile.amount_by_currency(_unreadable_run(spark, sf_dir)))


@query("recon_payables")
def recon_payables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open supplier invoices, one per order line, by currency."""
    spec = parse_spec(PAYABLE_SPEC)["payable"]
    source = read_table(spark, sf_dir, "lineitem").select(
        *[F.expr(e).alias(c) for c, e in PAYABLE_EXTRACT.items()]
    )
    rows = classify(spec, source)
    return doubles(reconcile.amount_by_currency(EntityResult(spec, source, rows)))


@query("audit_sample")
def audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 customers, vendors and items for a field-by-field review."""
    run = migrated(spark, sf_dir, "customer", "vendor", "item")
    return union_all(
        [
            reconcile.audit_sample(r).select(F.lit(n).alias("entity"), F.col("`No.`").alias("no"))
            for n, r in run.results.items()
        ]
    )


@query("recon_row_accounting")
def recon_row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.row_accounting(migrated(spark, sf_dir))


def _text_checksums(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.col(c).cast("string") for c in df.columns if c.endswith("_checksum")}
    )


@query("recon_key_checksum")
def recon_key_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_checksums(reconcile.key_checksums(migrated(spark, sf_dir)))


@query("recon_key_buckets")
def recon_key_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_checksums(reconcile.key_checksums(migrated(spark, sf_dir), per_bucket=True))


@query("recon_amount_by_currency")
def recon_amount_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(
        reconcile.amount_by_currency(migrated(spark, sf_dir, "open_invoice")["open_invoice"])
    )


@query("recon_gl_accounts")
def recon_gl_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = migrated(spark, sf_dir, "gl_opening_balance")
    return doubles(reconcile.account_totals(run["gl_opening_balance"]))


@query("recon_trial_balance")
def recon_trial_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = migrated(spark, sf_dir, "gl_opening_balance")
    return doubles(reconcile.trial_balance(run["gl_opening_balance"]))


@query("recon_suspense_zero")
def recon_suspense_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = migrated(spark, sf_dir, "gl_opening_balance")
    return doubles(reconcile.trial_balance(run["gl_opening_balance"], accounts=["320100"]))


@query("recon_report_rows")
def recon_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.check_rows(migrated(spark, sf_dir))


@query("recon_summary")
def recon_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.summary(reconcile.check_rows(migrated(spark, sf_dir)))


@query("gate_outcomes")
def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a whole run and over one in which loaded rows are lost: checks, failures, and whether it stopped."""
    run = migrated(spark, sf_dir)
    vendor = replace(run["vendor"], classified=run["vendor"].classified.filter("`No.` NOT LIKE '%7'"))
    tampered = Migration(spark, run.folder, {**run.results, "vendor": vendor})
    parts = []
    for name, case in (("whole", run), ("rows lost", tampered)):
        checks = materialise(reconcile.check_rows(case))
        try:
            reconcile.gate(checks)
            stopped = False
        except reconcile.CheckFailed:
            stopped = True
        counts = checks.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"))
        parts.append(counts.select(F.lit(name).alias("run"), "checks", "failed", F.lit(stopped).alias("stopped")))
    return union_all(parts)


# --- profiling ---------------------------------------------------------------------------------


@query("profile_columns")
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = extracts(spark, sf_dir)
    return union_all(
        [profile.profile_columns(df, name).drop("position") for name, df in sorted(tables.items())]
    )


@query("profile_flags")
def profile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_metrics(extract(spark, sf_dir, "CUSTTABLE"), "CUSTTABLE").select(
        "table", "column", "n_spaces", "mixed_case", "n_bad_email"
    )


@query("profile_sample")
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_metrics(extract(spark, sf_dir, "CUSTTRANSOPEN"), "CUSTTRANSOPEN").select(
        "table", "column", "n_distinct", F.coalesce("sample", F.lit("")).alias("sample")
    )


@query("profile_approximate")
def profile_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated profiles of all tables: null shares, and whether the estimates are near the exact counts."""
    parts = []
    for name, df in sorted(extracts(spark, sf_dir).items()):
        exact = profile.column_metrics(df, name).select("column", F.col("n_distinct").alias("exact"))
        close = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.1 * F.col("exact")
        found = profile.approximate_columns(df, name).join(exact, "column")
        parts.append(found.select("table", "column", "null_pct", close.alias("close")))
    return union_all(parts)


@query("profile_merged")
def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two deliveries of every table, stored and merged; counts are exact, estimates near the exact ones."""
    folder = new_folder(spark, "profiles")
    tables = sorted(extracts(spark, sf_dir).items())
    early = F.pmod(F.xxhash64(SOURCE_ROW), F.lit(3)) == 0

    def store(name: str, rows: DataFrame, day: str) -> None:
        profile_store.stored_profile(rows, name).write.parquet(f"{folder}/{name}/{day}")

    # side by side, as a delivery of a small table is one task
    deliveries = [(name, df.filter(part), day) for name, df in tables for day, part in (("1", early), ("2", ~early))]
    run_jobs(spark, {f"{name}/{day}": partial(store, name, rows, day) for name, rows, day in deliveries})
    parts = []
    for name, df in tables:
        stored = [spark.read.parquet(f"{folder}/{name}/{day}") for day in "12"]
        merged = profile_store.read_profile(profile_store.merge_profiles(stored))
        exact = profile.column_metrics(df, name).select("column", F.col("n_distinct").alias("exact"))
        close = F.abs(F.col("n_distinct") - F.col("exact")) <= profile_store.DISTINCT_ERROR * F.col("exact")
        parts.append(
            merged.join(exact, "column").select(
                "table", "column", "n_rows", "null_pct", "smallest", "largest", "n_spaces", "mixed_case", "n_bad_email", close.alias("close")
            )
        )
    return union_all(parts)


@query("profile_missing")
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [
            profile.missing_values(df, name)
            for name, df in sorted(extracts(spark, sf_dir).items())
        ]
    )


@query("profile_duplicate_keys")
def profile_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [
            profile.duplicate_keys(extract(spark, sf_dir, name), name, key)
            for name, key in profile.PROFILE_KEYS.items()
        ]
    )


@query("profile_all_tables")
def profile_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_tables(extracts(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------------------------


def _as_text(df: DataFrame, columns: list[str]) -> Column:
    """A row's columns as one text; what is null or empty is nothing between two separators."""
    return F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]).alias("cells")


@query("csv_scan_nulls")
def csv_scan_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every extract written as CSV with all null tokens in its gaps, and read back."""
    folder = new_folder(spark, "csv")
    tokens = F.array(*map(F.lit, NULL_TOKENS))

    def one(name: str, df: DataFrame) -> DataFrame:
        columns = [c for c in df.columns if c != SOURCE_ROW]
        filled = {
            c: F.coalesce(col(c), F.element_at(tokens, (F.pmod(F.col(SOURCE_ROW) + i, F.lit(len(NULL_TOKENS))) + 1).cast("int")))
            for i, c in enumerate(columns)
        }
        sinks.write_table(df.withColumns(filled).select(*columns), f"{folder}/{name}", "csv")
        back = read_extract(spark, f"{folder}/{name}", columns)
        nulls = sum((col(c).isNull().cast("int") for c in columns), F.lit(0)).alias("nulls")
        return back.select(F.lit(name).alias("table"), nulls, _as_text(back, columns))

    parts = run_jobs(spark, {name: partial(one, name, df) for name, df in sorted(extracts(spark, sf_dir).items())})
    return union_all(list(parts.values()))


@query("sink_roundtrip")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows and rejects of all entities with all their columns, written as CSV and read back."""
    folder = new_folder(spark, "results")
    run = migrated(spark, sf_dir)
    sinks.write_results(run, f"{folder}/target", f"{folder}/rejects", "csv")
    parts = []
    for name, result in run.results.items():
        for side, kept, place in (("loaded", result.loaded, "target"), ("rejected", result.rejects, "rejects")):
            columns = [c for c in kept.columns if c != REASON]
            back = read_extract(spark, f"{folder}/{place}/{name}", kept.columns, null_tokens=())
            reason = col(REASON) if side == "rejected" else F.lit("")
            parts.append(
                back.select(F.lit(name).alias("entity"), F.lit(side).alias("side"), reason.alias(REASON), _as_text(back, columns))
            )
    return union_all(parts)


LEDGER_KEYS = ["EntryNo-1", "$Company"]
ADDED_ENTRY = 10**12


def _ledger_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Yesterday's customer ledger, and today's with rows deleted, corrected and added."""
    old = export(spark, sf_dir, "CustLedgerEntry-21")
    number, text = F.col("`EntryNo-1`"), F.col("`Description-7`")
    corrected = F.when(number % 89 == 3, F.concat(text, F.lit(" (corrected)"))).otherwise(text)
    kept = old.filter(number % 97 != 5).withColumn("Description-7", corrected)
    added = old.filter(number % 101 == 7).withColumn("EntryNo-1", number + ADDED_ENTRY)
    return old, kept.unionByName(added)


def _ledger_rows(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        F.col("`EntryNo-1`").alias("entry_no"), F.col("`$Company`").alias("company"), F.col("`Description-7`").alias("description"), *more
    )


@query("change_set")
def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two exports of the customer ledger: planted deletions, corrections and additions."""
    old, new = _ledger_versions(spark, sf_dir)
    return _ledger_rows(changes.change_set(old, new, LEDGER_KEYS), changes.CHANGE)


@query("incremental_load")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's ledger stored, today's changes loaded into it; the table as it is then."""
    old, new = _ledger_versions(spark, sf_dir)
    path = new_folder(spark, "ledger")
    changes.write_keyed(old, path, LEDGER_KEYS)
    found = materialise(changes.change_set(changes.read_keyed(spark, path), new, LEDGER_KEYS))
    changes.load_changes(spark, path, found, LEDGER_KEYS)
    return _ledger_rows(changes.read_keyed(spark, path))


@query("key_differences")
def key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which some are lost, doubled or renamed after loading: exactly their keys."""
    result = migrated(spark, sf_dir, "item")["item"]
    no = F.col("`No.`")
    kept = result.classified.filter(~no.endswith("17"))
    renamed = kept.withColumn("No.", F.when(no.endswith("39"), F.concat(no, F.lit("X"))).otherwise(no))
    tampered = renamed.unionByName(renamed.filter(no.endswith("28")))
    found = reconcile.key_differences(replace(result, classified=tampered))
    return found.select(no.alias("no"), "surplus")


@query("resumed_migration")
def resumed_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that breaks at the invoices and is taken up again: what it had committed is kept."""
    sources = dict(extracts(spark, sf_dir).items())
    folder = new_folder(spark, "migration")
    broken = {**sources, "CUSTTRANSOPEN": sources["CUSTTRANSOPEN"].drop("AMOUNTCUR")}
    try:
        migrate(spark, broken, folder=folder, resume=True)
    except KeyError:
        pass
    run = migrate(spark, sources, folder=folder, resume=True)
    return reconcile.entity_summary(run).withColumn("resumed", F.col("entity").isin(*run.resumed)).drop("missing_currency")


@query("export_roundtrip")
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exports, the company map and a table with an unusual name written, discovered and read
    again: rows per table and company."""
    folder = new_folder(spark, "export")
    written = {n: export(spark, sf_dir, n) for n in EXPORTS}
    written["company_map"] = company_map(spark, sf_dir).withColumnRenamed("CompanyName", "$Company")
    written["Item2Lot_x-50100"] = written["Customer-18"]
    sinks.write_exports(written, folder)
    return union_all(
        [
            df.groupBy(F.col("`$Company`").alias("company"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(name).alias("table"), "company", "rows")
            for name, df in export_source.read_exports(spark, folder + "/").items()
        ]
    )


def _written_extracts(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """All extracts as CSV files with quoted line breaks and stray inch marks; their folder, and what was written."""
    folder = new_folder(spark, "extracts")
    sources = {}
    for name, df in extracts(spark, sf_dir).items():
        names = [c for c in df.columns if c in ("NAME", "ITEMNAME")]
        broken = {c: F.concat(c, F.lit("\n"), F.lit('of "two" lines, 19" wide')) for c in names}
        sources[name] = df.withColumns(broken) if broken else df
        parts = sources[name].repartitionByRange(3, SOURCE_ROW).sortWithinPartitions(SOURCE_ROW)
        sinks.write_table(parts.drop(SOURCE_ROW), f"{folder}/{name}", "csv")
    return folder, sources


@query("landed_migration")
def landed_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts written as several CSV files with quoted line breaks, landed, migrated and counted against
    the extracts themselves."""
    folder, sources = _written_extracts(spark, sf_dir)
    landed = land_folder(spark, folder, f"{folder}-landed", multi_line=True)
    run = migrate(spark, landed)
    written = reconcile.entity_totals(run).select("entity", "loaded_rows", "rejected_rows")
    counted = union_all(
        [
            df.agg(F.count(F.lit(1)).alias("source_rows")).select(F.lit(e.name).alias("entity"), "source_rows")
            for e in load_spec().values()
            for df in [sources[e.source]]
        ]
    )
    return counted.join(written, "entity")


@query("landed_accounting")
def landed_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row accounting from the records that the reader counted in the text to the rows that were written."""
    folder, sources = _written_extracts(spark, sf_dir)
    target = f"{folder}-landed"
    landed = land_folder(spark, folder, target, multi_line=True)
    run = migrate(spark, landed, counted=landing_counts(spark, target, list(landed)))
    return reconcile.row_accounting(run)


@query("landed_rows_lost")
def landed_rows_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with rows that get lost between text and landed table: exactly their entities fail."""
    folder, sources = _written_extracts(spark, sf_dir)
    target = f"{folder}-landed"
    landed = land_folder(spark, folder, target, multi_line=True)
    kept = {
        "VENDTABLE": landed["VENDTABLE"].filter("ACCOUNTNUM NOT LIKE '%7'"),
        "INVENTTABLE": landed["INVENTTABLE"].filter("ITEMID NOT LIKE '%31'"),
    }
    run = migrate(spark, {**landed, **kept}, counted=landing_counts(spark, target, list(landed)))
    return reconcile.row_accounting(run)


@query("report_json")
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check report written as JSON and read back."""
    folder = new_folder(spark, "report")
    sinks.write_checks(reconcile.check_rows(migrated(spark, sf_dir)), folder)
    totals = spark.read.schema("passed bigint, total bigint").json(f"{folder}/totals")
    checks = spark.read.schema("entity string, check string, passed boolean").json(f"{folder}/checks")
    return checks.groupBy("entity").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed")
    ).unionByName(totals.select(F.lit("total").alias("entity"), F.col("total").alias("checks"), "passed"))


@query("created_views")
def created_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views as created in the catalog over loaded tables: rows of each."""
    folder = new_folder(spark, "views")
    schema = "tallybridge_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}'")
    export_source.load_tables(spark, exports(spark, sf_dir), schema)
    names = views.create_views(spark, f"{schema}_views", schema)
    return export_source.row_counts({n.split(".")[1]: spark.table(n) for n in names}).withColumnRenamed("table", "view")


@query("load_tables_counts")
def load_tables_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exported tables loaded as managed tables of a new schema; rows per table."""
    folder = new_folder(spark, "load")
    schema = "tallybridge_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}'")
    names = export_source.load_tables(spark, exports(spark, sf_dir), schema)
    return export_source.row_counts({n.split(".")[1]: spark.table(n) for n in names})


# --- compatibility views -----------------------------------------------------------------------


def _view_query(key: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return doubles(views.build_views(exports(spark, sf_dir))[name])

    QUERIES[key] = run


for _name in views.VIEW_FUNCTIONS:
    _view_query(f"view_{_name.lower()}", _name)


@query("view_ledgertrans_shuffled")
def view_ledgertrans_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger view with a company map that is taken for too large to broadcast."""
    return doubles(views.build_views(exports(spark, sf_dir), max_rows=0)["LEDGERTRANS"])


@query("company_map")
def company_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company map with the number of customers that each company brings."""
    customers = (
        export(spark, sf_dir, "Customer-18")
        .groupBy(F.col("`$Company`").alias("CompanyName"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return company_map(spark, sf_dir).join(customers, "CompanyName")


@query("detail_amounts")
def detail_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(views.detail_amounts(exports(spark, sf_dir)))


def _report_query(key: str, report: Callable[..., DataFrame], *args) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return doubles(report(views.build_views(exports(spark, sf_dir)), *args))

    QUERIES[key] = run


_report_query("open_ar_by_company", view_reports.open_ar_by_company)
_report_query("ledger_net_by_company", view_reports.ledger_net_by_company)
_report_query("overdue_by_branch", view_reports.overdue_by_branch, OVERDUE_BEFORE)
_report_query("view_row_counts", view_reports.view_row_counts)


@query("ledger_entries_by_company")
def ledger_entries_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_reports.ledger_entries_by_company(export(spark, sf_dir, "CustLedgerEntry-21"))


def _check_query(key: str, check: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = exports(spark, sf_dir)
        return doubles(
            view_checks.check_views(
                tables, views.build_views(tables), [UNMAPPED_COMPANY], checks=[check]
            )
        )

    QUERIES[f"vcheck_{key}"] = run


for _key, _check in (
    ("map_unique", view_checks.MAP_UNIQUE),
    ("custtable_rows", view_checks.CUSTTABLE_ROWS),
    ("custtrans_rows", view_checks.CUSTTRANS_ROWS),
    ("initial_amount", view_checks.INITIAL_AMOUNT),
    ("open_balance", view_checks.OPEN_BALANCE),
    ("open_items", view_checks.OPEN_ITEMS),
    ("bank_amount", view_checks.BANK_AMOUNT),
    ("ledger_zero", view_checks.LEDGER_ZERO),
    ("null_company", view_checks.NULL_COMPANY),
    ("unmapped_set", view_checks.UNMAPPED),
):
    _check_query(_key, _check)


@query("vcheck_open_item_set")
def vcheck_open_item_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = exports(spark, sf_dir)
    return view_checks.open_item_differences(tables, views.build_views(tables))


@query("vcheck_open_item_planted")
def vcheck_open_item_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open items against flags of which some are planted wrong: those, and no others, are found."""
    tables = dict(exports(spark, sf_dir).items())
    shown = views.build_views(tables)
    flag = F.when(F.col("`EntryNo-1`") % 211 == 3, ~F.col("`Open-36`")).otherwise(F.col("`Open-36`"))
    wrong = {**tables, "CustLedgerEntry_21": tables["CustLedgerEntry_21"].withColumn("Open-36", flag)}
    return view_checks.open_item_differences(wrong, shown)


@query("vcheck_all")
def vcheck_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of all view checks, each export read once."""
    return doubles(view_checks.check_exports(exports(spark, sf_dir), [UNMAPPED_COMPANY]))


@query("vcheck_summary")
def vcheck_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All view checks in one plan, one row per check."""
    return view_checks.check_summary(
        view_checks.check_exports(exports(spark, sf_dir), [UNMAPPED_COMPANY])
    )
