"""Checks of the compatibility views against the exported tables, per company.

The source side translates companies through the *distinct* company map: a company listed twice
doubles every view row, and then shows here as a difference instead of inflating both sides.

:func:`check_views` takes any views: it sums each of them, and each table, per company, makes the sums rows ``check, item,
side, value``, and brings the two sides of each check together in one small group-by. :func:`check_exports` gives the same
rows for the views as they are built over the tables, and reads each table once for all checks and both sides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.operators.compare import union_all, within
from tallybridge.plans.spec import col
from tallybridge.plans.views import APPLIED, COMPANY, INITIAL, VIEWS

Frames = Mapping[str, DataFrame]

# Largest accepted difference and the titles of the checks.
TOLERANCE = 0.01
MAP_UNIQUE = "company_map has one row per company"
CUSTTABLE_ROWS = "CUSTTABLE rows = mapped Customer rows"
CUSTTRANS_ROWS = "CUSTTRANS rows = mapped Cust. Ledger Entry rows"
INITIAL_AMOUNT = "CUSTTRANS AMOUNTCUR = detailed 'Initial Entry' amounts"
OPEN_BALANCE = "CUSTTRANSOPEN balance = sum of all detailed entries (open AR)"
OPEN_ITEMS = "CUSTTRANSOPEN items = entries flagged Open"
BANK_AMOUNT = "BANKACCOUNTTRANS amount = Bank Account Ledger Entry amount"
LEDGER_ZERO = "LEDGERTRANS nets to zero per company (double entry)"
NULL_COMPANY = "No NULL DATAAREAID in any view"
UNMAPPED = "DQ view reports the expected unmapped companies"

VIEW, SOURCE = "view_value", "source_value"


@dataclass(frozen=True)
class Measure:
    """Sum of ``value`` over the rows that meet ``where``; no such row, no measure."""

    check: str
    value: str = "1"
    where: str = "true"


VIEW_MEASURES = {
    "CUSTTABLE": [Measure(CUSTTABLE_ROWS)],
    "CUSTTRANS": [Measure(CUSTTRANS_ROWS), Measure(INITIAL_AMOUNT, "AMOUNTCUR")],
    "CUSTTRANSOPEN": [Measure(OPEN_BALANCE, "AMOUNTCUR"), Measure(OPEN_ITEMS)],
    "BANKACCOUNTTRANS": [Measure(BANK_AMOUNT, "AMOUNTCUR")],
    "LEDGERTRANS": [Measure(LEDGER_ZERO, "AMOUNTMST")],
}
# The open balance sums all detailed entries, also of types that the views do not know.
SOURCE_MEASURES = {
    "Customer_18": [Measure(CUSTTABLE_ROWS)],
    "CustLedgerEntry_21": [Measure(CUSTTRANS_ROWS), Measure(OPEN_ITEMS, where="`Open-36`")],
    "DetailedCustLedgEntry_379": [
        Measure(INITIAL_AMOUNT, "`Amount-7`", f"`EntryType-3` = '{INITIAL}'"),
        Measure(OPEN_BALANCE, "`Amount-7`"),
    ],
    "BankAccountLedgerEntry_271": [Measure(BANK_AMOUNT, "`Amount-13`")],
}
ALL_CHECKS = (
    MAP_UNIQUE,
    CUSTTABLE_ROWS,
    CUSTTRANS_ROWS,
    INITIAL_AMOUNT,
    OPEN_BALANCE,
    OPEN_ITEMS,
    BANK_AMOUNT,
    LEDGER_ZERO,
    NULL_COMPANY,
    UNMAPPED,
)


def _entry(check: str, item: Column, side: str, value: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        item.cast("string").alias("item"),
        F.lit(side).alias("side"),
        value.cast("decimal(28,2)").alias("value"),
    )


def _entries(rows: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _per_company(rows: DataFrame, company: str, measures: Sequence[Measure]) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, m in enumerate(measures):
        where = F.expr(m.where)
        aggregates += [
            F.count_if(where).alias(f"n_{i}"),
            F.sum(F.when(where, F.expr(m.value))).alias(f"sum_{i}"),
        ]
    return rows.groupBy(col(company).alias("company")).agg(*aggregates)


def _measured(measures: Sequence[Measure], item: Column, side: str) -> list[Column]:
    return [
        F.when(F.col(f"n_{i}") > 0, _entry(m.check, item, side, F.col(f"sum_{i}")))
        for i, m in enumerate(measures)
    ]


def _literal_entries(spark: SparkSession, entries: Sequence[Column]) -> DataFrame:
    return _entries(spark.range(1), entries)


def check_views(
    tables: Frames,
    views: Frames,
    expected_unmapped: Sequence[str] = (),
    checks: Sequence[str] = ALL_CHECKS,
) -> DataFrame:
    """``check, item, view_value, source_value, passed`` for the named checks.

    ``item`` is the company code, or for checks that are not per company the view, the map or the
    company name. A value that is missing on one side is null and fails.
    """
    spark = tables["company_map"].sparkSession
    nothing = F.lit(0)
    parts: list[DataFrame] = []
    literals: list[Column] = []

    for view in VIEWS:
        measures = [m for m in VIEW_MEASURES[view] if m.check in checks]
        if not measures and NULL_COMPANY not in checks:
            continue
        company = F.col("company")
        entries = _measured(measures, company, VIEW)
        if LEDGER_ZERO in [m.check for m in measures]:
            entries.append(_entry(LEDGER_ZERO, company, SOURCE, nothing))
        if NULL_COMPANY in checks:
            without = F.when(
                company.isNull(), _entry(NULL_COMPANY, F.lit(view), VIEW, F.col("n_rows"))
            )
            entries.append(without)
            literals += [
                _entry(NULL_COMPANY, F.lit(view), side, nothing) for side in (VIEW, SOURCE)
            ]
        parts.append(_entries(_per_company(views[view], "DATAAREAID", measures), entries))

    codes = tables["company_map"].select("CompanyName", "DATAAREAID").distinct()
    for table, all_measures in SOURCE_MEASURES.items():
        measures = [m for m in all_measures if m.check in checks]
        if measures:
            sums = _per_company(tables[table], COMPANY.strip("`"), measures)
            mapped = sums.join(codes, F.col("company") == F.col("CompanyName"))
            parts.append(_entries(mapped, _measured(measures, F.col("DATAAREAID"), SOURCE)))

    if MAP_UNIQUE in checks:
        item = F.lit("company_map")
        repeated = tables["company_map"].groupBy("CompanyName").count().filter("count > 1")
        parts.append(_entries(repeated, [_entry(MAP_UNIQUE, item, VIEW, F.lit(1))]))
        literals += [_entry(MAP_UNIQUE, item, side, nothing) for side in (VIEW, SOURCE)]
    if UNMAPPED in checks:
        company = F.col("CompanyName")
        reported = unmapped_companies(views)
        parts.append(_entries(reported, [_entry(UNMAPPED, company, VIEW, F.lit(1))]))
        literals += [
            _entry(UNMAPPED, F.lit(c), SOURCE, F.lit(1)) for c in sorted(set(expected_unmapped))
        ]
    if literals:
        parts.append(_literal_entries(spark, literals))

    return _sides(parts)


def _sides(parts: Sequence[DataFrame]) -> DataFrame:
    """Both values of each check and item, and whether they agree."""
    sides = (
        union_all(parts)
        .groupBy("check", "item")
        .agg(*[F.sum(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in (VIEW, SOURCE)])
    )
    return sides.withColumn("passed", within(F.col(VIEW), F.col(SOURCE), TOLERANCE))


def _entry_sums(tables: Frames) -> DataFrame:
    """Customer ledger and its details per company, as the views and the source side of the checks see them.

    Entries and details meet in one group-by on entry and company, not in a join: each detail counts once for the
    source side, and once for each entry of that number for the views. What has no number or company meets nothing.
    """
    ledger = tables["CustLedgerEntry_21"].select(
        F.col("`EntryNo-1`").alias("entry_no"),
        F.col(COMPANY).alias("company"),
        F.lit(1).cast("bigint").alias("n"),
        F.expr("CAST(`Open-36` AS BIGINT)").alias("flagged"),
    )
    amount = F.col("`Amount-7`")

    def of(kind: str) -> Column:
        return F.when(F.col("`EntryType-3`") == kind, amount)

    details = tables["DetailedCustLedgEntry_379"].select(
        F.col("`CustLedgerEntryNo-2`").alias("entry_no"),
        F.col(COMPANY).alias("company"),
        of(INITIAL).alias("initial"),
        of(APPLIED).alias("applied"),
        amount.alias("total"),
        F.lit(1).cast("bigint").alias("n_details"),
        (F.col("`EntryType-3`") == INITIAL).cast("bigint").alias("n_initial"),
    )
    entries = union_all([ledger, details], partial_columns=True).groupBy("entry_no", "company").agg(
        *[F.sum(c).alias(c) for c in ("n", "flagged", "initial", "applied", "total", "n_details", "n_initial")]
    )
    n, named = F.coalesce("n", F.lit(0)), F.col("entry_no").isNotNull() & F.col("company").isNotNull()
    initial, applied = (F.coalesce(F.when(named, F.col(c)), F.lit(0).cast("decimal(28,2)")) for c in ("initial", "applied"))
    balance = F.round(initial + applied, 2)
    opened = F.when(balance != 0, n).otherwise(0)
    return entries.groupBy("company").agg(
        F.sum(n).alias("n_entries"),
        F.sum(n * initial).alias("view_initial"),
        F.sum(opened).alias("n_open"),
        F.sum(opened * balance).alias("view_open"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("n_flagged"),
        F.coalesce(F.sum("n_initial"), F.lit(0)).alias("n_initial"),
        F.sum("initial").alias("source_initial"),
        F.coalesce(F.sum("n_details"), F.lit(0)).alias("n_details"),
        F.sum("total").alias("source_open"),
    )


def check_exports(tables: Frames, expected_unmapped: Sequence[str] = ()) -> DataFrame:
    """All checks of :func:`check_views` for the views as they are built over ``tables``, with each export read once.

    The views translate companies row by row, but all that is checked adds up per company. So every export is
    summed per company first, and the few sums meet the company map: the view side once for each map row of a
    company, the source side once for each distinct one.
    """
    spark = tables["company_map"].sparkSession
    one = F.lit(1)
    sums = union_all(
        [
            _entry_sums(tables),
            tables["Customer_18"].groupBy(F.col(COMPANY).alias("company")).agg(F.count(one).alias("n_customers")),
            tables["BankAccountLedgerEntry_271"]
            .groupBy(F.col(COMPANY).alias("company"))
            .agg(F.count(one).alias("n_bank"), F.sum("`Amount-13`").alias("bank")),
            tables["GLEntry_17"]
            .groupBy(F.col(COMPANY).alias("company"))
            .agg(F.count(one).alias("n_postings"), F.sum("`Amount-17`").alias("net")),
        ],
        partial_columns=True,
    ).groupBy("company")
    measures = (
        "n_entries", "view_initial", "n_open", "view_open", "n_flagged", "n_initial", "source_initial", "n_details",
        "source_open", "n_customers", "n_bank", "bank", "n_postings", "net",
    )
    sums = sums.agg(*[F.sum(m).alias(m) for m in measures])
    codes = tables["company_map"].groupBy("CompanyName", "DATAAREAID").agg(F.count(one).alias("copies"))
    rows = sums.join(codes, F.col("company") == F.col("CompanyName"), "left")

    code, copies = F.col("DATAAREAID"), F.col("copies")

    def entry(check: str, side: str, count: str, value: str | Column) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        shown = value * copies if side == VIEW else value
        return F.when(copies.isNotNull() & (F.col(count) > 0), _entry(check, code, side, shown))

    entries = [
        entry(check, side, count, value)
        for check, side, count, value in (
            (CUSTTABLE_ROWS, VIEW, "n_customers", "n_customers"),
            (CUSTTABLE_ROWS, SOURCE, "n_customers", "n_customers"),
            (CUSTTRANS_ROWS, VIEW, "n_entries", "n_entries"),
            (CUSTTRANS_ROWS, SOURCE, "n_entries", "n_entries"),
            (INITIAL_AMOUNT, VIEW, "n_entries", "view_initial"),
            (INITIAL_AMOUNT, SOURCE, "n_initial", "source_initial"),
            (OPEN_BALANCE, VIEW, "n_open", "view_open"),
            (OPEN_BALANCE, SOURCE, "n_details", "source_open"),
            (OPEN_ITEMS, VIEW, "n_open", "n_open"),
            (OPEN_ITEMS, SOURCE, "n_flagged", "n_flagged"),
            (BANK_AMOUNT, VIEW, "n_bank", "bank"),
            (BANK_AMOUNT, SOURCE, "n_bank", "bank"),
            (LEDGER_ZERO, VIEW, "n_postings", "net"),
            (LEDGER_ZERO, SOURCE, "n_postings", F.lit(0)),
        )
    ]
    counts = dict(zip(VIEWS, ("n_customers", "n_entries", "n_open", "n_bank", "n_postings")))
    for view, count in counts.items():
        missing = copies.isNotNull() & code.isNull() & (F.col(count) > 0)
        entries.append(F.when(missing, _entry(NULL_COMPANY, F.lit(view), VIEW, F.col(count) * copies)))
    listed = [F.coalesce(F.col(counts[v]), F.lit(0)) > 0 for v in ("CUSTTABLE", "CUSTTRANS", "BANKACCOUNTTRANS", "LEDGERTRANS")]
    entries.append(
        F.when(code.isNull() & (listed[0] | listed[1] | listed[2] | listed[3]), _entry(UNMAPPED, F.col("company"), VIEW, one))
    )
    repeated = tables["company_map"].groupBy("CompanyName").count().filter("count > 1")
    nothing = F.lit(0)
    literals = [_entry(NULL_COMPANY, F.lit(v), side, nothing) for v in VIEWS for side in (VIEW, SOURCE)]
    literals += [_entry(MAP_UNIQUE, F.lit("company_map"), side, nothing) for side in (VIEW, SOURCE)]
    literals += [_entry(UNMAPPED, F.lit(c), SOURCE, one) for c in sorted(set(expected_unmapped))]
    return _sides(
        [
            _entries(rows, entries),
            _entries(repeated, [_entry(MAP_UNIQUE, F.lit("company_map"), VIEW, one)]),
            _literal_entries(spark, literals),
        ]
    )


def check_summary(rows: DataFrame) -> DataFrame:
    """One row per check: it passes when all its rows do."""
    return rows.groupBy("check").agg(
        F.count(F.lit(1)).alias("items"), F.bool_and("passed").alias("passed")
    )


def unmapped_companies(views: Frames) -> DataFrame:
    """Companies whose rows the views leave out."""
    return views["DQ_UNMAPPED_COMPANIES"].select("CompanyName").distinct()


def open_item_differences(tables: Frames, views: Frames) -> DataFrame:
    """Entries that are open in the view or by flag, but not both; empty when they agree.

    Entry numbers repeat between companies, so an entry is named by its company and number.
    """
    codes = tables["company_map"].select("CompanyName", "DATAAREAID").distinct()
    flagged = (
        tables["CustLedgerEntry_21"]
        .filter("`Open-36`")
        .join(codes, F.col(COMPANY) == F.col("CompanyName"))
        .select("DATAAREAID", F.col("`EntryNo-1`").alias("REFRECID"))
    )
    shown = views["CUSTTRANSOPEN"].select("DATAAREAID", "REFRECID")
    return (
        shown.select("*", F.lit(1).alias("in_view"), F.lit(0).alias("in_source"))
        .union(flagged.select("*", F.lit(0), F.lit(1)))
        .groupBy("DATAAREAID", "REFRECID")
        .agg(F.max("in_view").alias("in_view"), F.max("in_source").alias("in_source"))
        .filter(F.col("in_view") != F.col("in_source"))
    )
