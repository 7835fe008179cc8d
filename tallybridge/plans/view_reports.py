"""Report queries over the compatibility views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.plans.views import VIEWS

Views = Mapping[str, DataFrame]


def open_ar_by_company(views: Views) -> DataFrame:
    """Open receivables: items and amount per company."""
    return (
        views["CUSTTRANSOPEN"]
        .groupBy("DATAAREAID")
        .agg(F.count(F.lit(1)).alias("open_items"), F.sum("AMOUNTCUR").alias("open_amount"))
        .orderBy("DATAAREAID")
    )


def ledger_net_by_company(views: Views) -> DataFrame:
    return views["LEDGERTRANS"].groupBy("DATAAREAID").agg(F.sum("AMOUNTMST").alias("net"))


def overdue_by_branch(views: Views, before: str) -> DataFrame:
    """Overdue receivables per company, branch and customer group, largest first.

    An open item is an entry whose amount is not settled, so branch and balance come from the same
    row and the ledger is read once. Items are summed per customer before the customer table is joined: a
    customer that owns a large part of all items then reaches the join as a few rows. A company that
    the map lists twice counts its items twice, not four times.
    """
    open_amount = F.round(F.col("AMOUNTCUR") - F.col("SETTLEAMOUNTCUR"), 2)
    per_customer = (
        views["CUSTTRANS"]
        .filter(F.col("DUEDATE") < F.lit(before).cast("date"))
        .select("DATAAREAID", F.col("DIMENSION").alias("BRANCH"), "ACCOUNTNUM", open_amount.alias("open"))
        .filter(F.col("open") != 0)
        .groupBy("DATAAREAID", "BRANCH", "ACCOUNTNUM")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("open").alias("amount"))
    )
    groups = views["CUSTTABLE"].select("ACCOUNTNUM", "DATAAREAID", "CUSTGROUP")
    return (
        per_customer.join(groups, ["ACCOUNTNUM", "DATAAREAID"])
        .groupBy("DATAAREAID", "BRANCH", "CUSTGROUP")
        .agg(F.sum("items").alias("overdue_items"), F.sum("amount").alias("overdue_amount"))
        .orderBy(F.desc("overdue_amount"))
    )


def ledger_entries_by_company(ledger: DataFrame) -> DataFrame:
    """Quick look at a loaded customer ledger: entries and open entries per company."""
    return (
        ledger.groupBy(F.col("`$Company`").alias("company"))
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.count_if(F.col("`Open-36`")).alias("open_entries"),
        )
        .orderBy("company")
    )


def view_row_counts(views: Views) -> DataFrame:
    counts = [
        views[v].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(v).alias("view"), "rows")
        for v in VIEWS
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out
