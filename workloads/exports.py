"""New-system export tables, derived from the given tables.

Same scheme as the extracts: each row of a base relation yields one or more variants. An order is
an invoice entry; an order with status F is paid and yields the payment side as well. The company
and the copied customer fields follow from the customer key, so that no two large tables need to
be joined to make the inputs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.plans.views import LazyFrames
from workloads.extracts import _select, expand, read_table

COMPANY_CODES = {"AFRICA": "afr", "AMERICA": "ame", "ASIA": "asi", "EUROPE": "eur"}
UNMAPPED_COMPANY = "MIDDLE EAST"
OVERDUE_BEFORE = "1998-01-01"

_NO = "concat('C', lpad(CAST({k} AS STRING), 12, '0'))"
_CURRENCY = "CASE {k}%5 WHEN 3 THEN 'USD' WHEN 4 THEN 'AED' ELSE '' END"
_GROUP = "CASE {k}%3 WHEN 0 THEN 'DOMESTIC' WHEN 1 THEN 'EXPORT' ELSE 'INTERCO' END"
_PAYER_NO = _NO.format(k="o_custkey")
_PAYER_NAME = "concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0'))"
_PAYER_CURRENCY = _CURRENCY.format(k="o_custkey")
_AMOUNT = "amount"
_MINUS = "-amount"
_PAID = "o_orderstatus = 'F'"
_INVOICE_DATE = "o_orderdate"
_PAY_DATE = "o_orderdate + INTERVAL 20 DAY"
_INVOICE_NO = "concat('SI-', lpad(CAST(o_orderkey AS STRING), 12, '0'))"
_PAY_NO = "concat('BR-', lpad(CAST(o_orderkey AS STRING), 12, '0'))"
_INVOICE_TEXT = f"concat('Invoice ', {_INVOICE_NO})"
_INVOICE_ENTRY = "2*o_orderkey + 1"
_PAY_ENTRY = "2*o_orderkey + 2"
_STAMP = {
    "$Company": "r_name",
    "SystemModifiedAt-2000000003": "CAST('2026-09-20 02:00:00' AS TIMESTAMP)",
}

_CUSTOMER = {
    "No-1": _NO.format(k="c_custkey"),
    "Name-2": "c_name",
    "CustomerPostingGroup-21": _GROUP.format(k="c_custkey"),
    "CurrencyCode-22": _CURRENCY.format(k="c_custkey"),
    "CountryRegionCode-35": "n_name",
    "Blocked-39": "CASE c_custkey%10 WHEN 8 THEN 'Invoice' WHEN 9 THEN 'All' ELSE '' END",
    **_STAMP,
}
_LEDGER_INVOICE = {
    "EntryNo-1": _INVOICE_ENTRY,
    "CustomerNo-3": _PAYER_NO,
    "PostingDate-4": _INVOICE_DATE,
    "DocumentType-5": "'Invoice'",
    "DocumentNo-6": _INVOICE_NO,
    "Description-7": _INVOICE_TEXT,
    "CustomerName-8": _PAYER_NAME,
    "CurrencyCode-11": _PAYER_CURRENCY,
    "CustomerPostingGroup-22": _GROUP.format(k="o_custkey"),
    "GlobalDimension1Code-23": "o_orderpriority",
    "GlobalDimension2Code-24": (
        "CASE o_custkey%4 WHEN 0 THEN 'SALES' WHEN 1 THEN 'RETAIL' WHEN 2 THEN 'ONLINE' ELSE 'B2B' END"
    ),
    "Open-36": "o_orderstatus <> 'F'",
    "DueDate-37": "o_orderdate + INTERVAL 30 DAY",
    "DocumentDate-62": _INVOICE_DATE,
    **_STAMP,
}
_LEDGER_PAYMENT = {
    **_LEDGER_INVOICE,
    "EntryNo-1": _PAY_ENTRY,
    "PostingDate-4": _PAY_DATE,
    "DocumentType-5": "'Payment'",
    "DocumentNo-6": _PAY_NO,
    "Description-7": _PAYER_NAME,
    "Open-36": "FALSE",
    "DueDate-37": _PAY_DATE,
    "DocumentDate-62": _PAY_DATE,
}


def _detail(n: int, entry: str, kind: str, paid: bool, amount: str) -> dict[str, str]:
    return {
        "EntryNo-1": f"4*o_orderkey + {n}",
        "CustLedgerEntryNo-2": entry,
        "EntryType-3": f"'{kind}'",
        "PostingDate-4": _PAY_DATE if paid else _INVOICE_DATE,
        "DocumentType-5": "'Payment'" if paid else "'Invoice'",
        "DocumentNo-6": _PAY_NO if paid else _INVOICE_NO,
        "Amount-7": amount,
        "CustomerNo-9": _PAYER_NO,
        "CurrencyCode-12": _PAYER_CURRENCY,
        **_STAMP,
    }


def _posting(n: int, account: str, paid: bool, amount: str) -> dict[str, str]:
    return {
        "EntryNo-1": f"4*o_orderkey + {n}",
        "GLAccountNo-3": f"'{account}'",
        "PostingDate-4": _PAY_DATE if paid else _INVOICE_DATE,
        "DocumentNo-6": _PAY_NO if paid else _INVOICE_NO,
        "Description-7": _PAYER_NAME if paid else _INVOICE_TEXT,
        "Amount-17": amount,
        **_STAMP,
    }


_BANK = {
    "EntryNo-1": "o_orderkey",
    "BankAccountNo-3": "CASE o_orderkey%3 WHEN 0 THEN 'B0010' WHEN 1 THEN 'B0018' ELSE 'B0028' END",
    "PostingDate-4": _PAY_DATE,
    "DocumentType-5": "'Payment'",
    "DocumentNo-6": _PAY_NO,
    "Description-7": _PAYER_NAME,
    "CurrencyCode-11": _PAYER_CURRENCY,
    "Amount-13": _AMOUNT,
    "Open-36": "o_orderkey%20 = 0",
    **_STAMP,
}

# folder -> (base relation, [(condition, values of one variant)])
EXPORTS = {
    "Customer-18": ("customer_company", [("TRUE", _CUSTOMER)]),
    "CustLedgerEntry-21": (
        "order_company",
        [("TRUE", _LEDGER_INVOICE), (_PAID, _LEDGER_PAYMENT)],
    ),
    "DetailedCustLedgEntry-379": (
        "order_company",
        [
            ("TRUE", _detail(1, _INVOICE_ENTRY, "Initial Entry", False, _AMOUNT)),
            (_PAID, _detail(2, _PAY_ENTRY, "Initial Entry", True, _MINUS)),
            (_PAID, _detail(3, _INVOICE_ENTRY, "Application", True, _MINUS)),
            (_PAID, _detail(4, _PAY_ENTRY, "Application", True, _AMOUNT)),
        ],
    ),
    "BankAccountLedgerEntry-271": ("paid_order_company", [("TRUE", _BANK)]),
    "GLEntry-17": (
        "order_company",
        [
            ("TRUE", _posting(1, "13100", False, _AMOUNT)),
            ("TRUE", _posting(2, "40100", False, _MINUS)),
            (_PAID, _posting(3, "27100", True, _AMOUNT)),
            (_PAID, _posting(4, "13100", True, _MINUS)),
        ],
    ),
}

_CODE = "CASE r_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COMPANY_CODES.items()) + " END"


def company_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").select(
        F.col("r_name").alias("CompanyName"), F.expr(_CODE).alias("DATAAREAID")
    ).filter(F.col("CompanyName") != UNMAPPED_COMPANY)


def _relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Base rows with the name of their company; nations and regions are a handful of rows."""
    region = read_table(spark, sf_dir, "region")
    if name == "customer_company":
        nation = read_table(spark, sf_dir, "nation")
        customers = read_table(spark, sf_dir, "customer").join(
            nation, F.col("c_nationkey") == nation.n_nationkey
        )
        return customers.join(region, region.r_regionkey == F.expr("c_custkey % 5"))
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    orders = read_table(spark, sf_dir, "orders").withColumn("amount", amount)
    if name == "paid_order_company":
        orders = orders.filter(_PAID)
    return orders.join(region, region.r_regionkey == F.expr("o_custkey % 5"))


def export(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    base, variants = EXPORTS[folder]
    return expand(_relation(spark, sf_dir, base), variants)


def exports(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Every exported table under its table name, and the company map."""
    tables = {n.replace("-", "_"): partial(export, spark, sf_dir, n) for n in EXPORTS}
    return LazyFrames({**tables, "company_map": partial(company_map, spark, sf_dir)})


def oracle_ctes() -> dict[str, str]:
    ctes = {
        "customer_company": (
            "SELECT * FROM customer JOIN nation ON n_nationkey = c_nationkey "
            "JOIN region ON r_regionkey = c_custkey%5"
        ),
        "order_company": (
            "SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders "
            "JOIN region ON r_regionkey = o_custkey%5"
        ),
        "paid_order_company": f"SELECT * FROM order_company WHERE {_PAID}",
        "company_map": (
            f"SELECT r_name AS \"CompanyName\", {_CODE} AS \"DATAAREAID\" FROM region "
            f"WHERE r_name <> '{UNMAPPED_COMPANY}'"
        ),
    }
    for folder, (base, variants) in EXPORTS.items():
        name = folder.replace("-", "_")
        ctes[name] = " UNION ALL ".join(_select(v, base, cond) for cond, v in variants)
    return ctes
