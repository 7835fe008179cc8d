"""Old-system extracts, derived from the given tables.

Every value is an SQL expression that Spark and the SQL oracle read alike. A source row is written
as one or more *variants*: the row itself and, for some keys, a re-typed copy of it. Spark produces
the variants of a row in one pass; the oracle unions them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybridge.plans.views import LazyFrames

COPY_OFFSET = 1_000_000_000_000_000

_CURRENCY = "CASE WHEN {k}%75=11 THEN NULL WHEN {k}%5=3 THEN 'USD' WHEN {k}%5=4 THEN 'AED' ELSE 'INR' END"
_GROUP = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'EXP' WHEN 'MACHINERY' THEN 'INTERCO' "
    "WHEN 'HOUSEHOLD' THEN 'RETAIL' ELSE 'DOM' END"
)
_MONEY = "CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"

_CUSTOMER = {
    "_source_row": "c_custkey",
    "ACCOUNTNUM": "concat('C', lpad(CAST(c_custkey AS STRING), 12, '0'))",
    "NAME": "CASE WHEN c_custkey%97=5 THEN NULL ELSE c_name END",
    "CUSTGROUP": (
        f"CASE WHEN c_custkey%150=7 THEN 'ZZZ' WHEN c_custkey%40=3 THEN concat(lower({_GROUP}), '  ') "
        f"ELSE {_GROUP} END"
    ),
    "CURRENCY": _CURRENCY.format(k="c_custkey"),
    "EMAIL": (
        "CASE WHEN c_custkey%75=12 THEN 'not-an-email' "
        "ELSE concat(replace(c_name, '#', '.'), '@Example.com') END"
    ),
    "CITY": "CASE WHEN c_custkey%200=9 THEN concat(n_name, ' ') ELSE n_name END",
    "CREDITMAX": _MONEY.format(x="c_acctbal"),
    "BLOCKED": "CASE c_custkey%10 WHEN 8 THEN '1' WHEN 9 THEN '2' ELSE '0' END",
    "DATAAREAID": "'demo'",
}
_CUSTOMER_COPY = {
    **_CUSTOMER,
    "_source_row": f"c_custkey + {COPY_OFFSET}",
    "ACCOUNTNUM": f"concat(lower({_CUSTOMER['ACCOUNTNUM']}), ' ')",
    "NAME": "c_name",
}
_VENDOR = {
    "_source_row": "s_suppkey",
    "ACCOUNTNUM": "concat('V', lpad(CAST(s_suppkey AS STRING), 12, '0'))",
    "NAME": "s_name",
    "VENDGROUP": "CASE s_suppkey%3 WHEN 0 THEN 'LOCAL' WHEN 1 THEN 'IMPORT' ELSE 'SERVICE' END",
    "CURRENCY": "CASE s_suppkey%5 WHEN 3 THEN 'USD' WHEN 4 THEN 'AED' ELSE 'INR' END",
    "PAYMTERMID": (
        "CASE s_suppkey%4 WHEN 0 THEN 'NET30' WHEN 1 THEN 'NET45' WHEN 2 THEN 'NET60' ELSE 'COD' END"
    ),
    "DATAAREAID": "'demo'",
}
_ITEM = {
    "_source_row": "p_partkey",
    "ITEMID": "concat('IT-', lpad(CAST(p_partkey AS STRING), 12, '0'))",
    "ITEMNAME": "p_name",
    "ITEMGROUPID": "p_type",
    "UNITID": (
        "CASE WHEN p_partkey%80=13 THEN NULL ELSE CASE p_partkey%4 WHEN 0 THEN 'PCS' WHEN 1 THEN 'KG' "
        "WHEN 2 THEN 'BOX' ELSE 'LTR' END END"
    ),
    "PRICE": _MONEY.format(x="p_retailprice"),
    "DATAAREAID": "'demo'",
}
_OPEN_INVOICE = {
    "_source_row": "o_orderkey",
    "RECID": "CAST(5000001 + o_orderkey AS STRING)",
    "ACCOUNTNUM": (
        "CASE WHEN o_orderkey%450=7 THEN 'C999999999999' "
        "ELSE concat('C', lpad(CAST(o_custkey AS STRING), 12, '0')) END"
    ),
    "INVOICE": "concat('INV-', lpad(CAST(o_orderkey AS STRING), 12, '0'))",
    "TRANSDATE": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "DUEDATE": "CAST(NULL AS STRING)",
    "AMOUNTCUR": _MONEY.format(x="o_totalprice"),
    "CURRENCYCODE": _CURRENCY.format(k="o_custkey"),
    "DATAAREAID": "'demo'",
}

# table -> (base relation, [(condition, values of one variant)])
EXTRACTS = {
    "CUSTTABLE": (
        "customer_nation",
        [("TRUE", _CUSTOMER), ("c_custkey%100=17 OR c_custkey%970=5", _CUSTOMER_COPY)],
    ),
    "CUSTTRANSOPEN": ("orders", [("TRUE", _OPEN_INVOICE)]),
    "INVENTTABLE": ("part", [("TRUE", _ITEM)]),
    "VENDTABLE": ("supplier", [("TRUE", _VENDOR)]),
}

# LEDGERBALANCE: one row per account and department, and one row that closes the year to zero.
_ACCOUNT = "CASE l_returnflag WHEN 'A' THEN '110100' WHEN 'N' THEN '410100' ELSE '510100' END"
_ACCOUNT_NAME = (
    "CASE ACCOUNTNUM WHEN '110100' THEN 'Cash at bank' WHEN '410100' THEN 'Revenue' "
    "WHEN '510100' THEN 'Cost of goods sold' ELSE 'Retained earnings' END"
)
_DEPARTMENT = "CASE l_linenumber%3 WHEN 0 THEN 'SALES' WHEN 1 THEN 'OPS' ELSE 'ADMIN' END"
_LEDGER = {
    "_source_row": (
        "CAST(ACCOUNTNUM AS BIGINT)*10 + CASE DEPARTMENT WHEN 'SALES' THEN 0 WHEN 'OPS' THEN 1 ELSE 2 END"
    ),
    "ACCOUNTNUM": "ACCOUNTNUM",
    "ACCOUNTNAME": _ACCOUNT_NAME,
    "DEPARTMENT": "DEPARTMENT",
    "AMOUNTMST": _MONEY.format(x="amount"),
    "DATAAREAID": "'demo'",
}


# Amounts of open invoices of which some are no number, and open supplier invoices with their mapping.
UNREADABLE_AMOUNT = (
    "CASE WHEN _source_row%97=3 THEN '12,500.00' WHEN _source_row%97=4 THEN '   ' ELSE AMOUNTCUR END"
)
PAYABLE_EXTRACT = {
    "_source_row": "l_orderkey*8 + l_linenumber",
    "RECID": "CAST(l_orderkey*8 + l_linenumber AS STRING)",
    "AMOUNTCUR": _MONEY.format(x="l_extendedprice"),
    "CURRENCYCODE": _CURRENCY.format(k="l_suppkey"),
}
PAYABLE_SPEC = {
    "payable": {
        "source": "VENDTRANSOPEN",
        "key": {"source": "RECID", "target": "Id"},
        "fields": {
            "Id": {"from": "RECID"},
            "Amount": {"from": "AMOUNTCUR", "rules": ["to_decimal"]},
            "Currency Code": {"from": "CURRENCYCODE", "rules": ["trim", "upper", "lcy_blank"]},
        },
        "required": ["Amount"],
    }
}

_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def expand(base: DataFrame, variants: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """All variants of every base row, in one pass over the base.

    Only the variant number is exploded. Columns are computed from it afterwards, so that columns
    nobody asks for are neither computed nor read.
    """
    if len(variants) == 1 and variants[0][0] == "TRUE":
        return base.select(*[F.expr(e).alias(c) for c, e in variants[0][1].items()])
    numbers = [F.when(F.expr(cond), F.lit(i)) for i, (cond, _) in enumerate(variants)]
    rows = base.select("*", F.explode(F.array_compact(F.array(*numbers))).alias("variant"))
    return rows.select(*[_cell(c, variants).alias(c) for c in variants[0][1]])


def _cell(column: str, variants: list[tuple[str, dict[str, str]]]) -> Column:
    values = [v[column] for _, v in variants]
    if len(set(values)) == 1:
        return F.expr(values[0])
    cases = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return F.expr(f"CASE variant {cases} END")


def extract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One extract as a DataFrame of text columns plus its ``_source_row``."""
    if name == "LEDGERBALANCE":
        return _ledger_balance(spark, sf_dir)
    base, variants = EXTRACTS[name]
    if base == "customer_nation":
        customer = read_table(spark, sf_dir, "customer")
        nation = read_table(spark, sf_dir, "nation")
        relation = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    else:
        relation = read_table(spark, sf_dir, base)
    return expand(relation, variants)


def _ledger_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping sets give the balances and their grand total in one aggregation."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.expr(_ACCOUNT).alias("account"),
        F.expr(_DEPARTMENT).alias("department"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    totals = lines.groupingSets(
        [["account", "department"], []], "account", "department"
    ).agg(F.sum("price").alias("total"), F.grouping("account").alias("closing"))
    closing = F.col("closing") == 1
    balances = totals.select(
        F.when(closing, "320100").otherwise(F.col("account")).alias("ACCOUNTNUM"),
        F.when(closing, "ADMIN").otherwise(F.col("department")).alias("DEPARTMENT"),
        F.when(closing, -F.col("total")).otherwise(F.col("total")).alias("amount"),
    )
    return balances.select(*[F.expr(e).alias(c) for c, e in _LEDGER.items()])


def extracts(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Every extract under its name."""
    names = (*EXTRACTS, "LEDGERBALANCE")
    return LazyFrames({n: partial(extract, spark, sf_dir, n) for n in names})


def _select(values: dict[str, str], relation: str, cond: str) -> str:
    cells = ", ".join(f'{e} AS "{c}"' for c, e in values.items())
    return f"SELECT {cells} FROM {relation}" + ("" if cond == "TRUE" else f" WHERE {cond}")


def oracle_ctes() -> dict[str, str]:
    """The same extracts as common table expressions for the SQL oracle."""
    ctes = {
        "customer_nation": (
            "SELECT customer.*, nation.n_name FROM customer "
            "JOIN nation ON n_nationkey = c_nationkey"
        ),
        "balances": (
            f"SELECT {_ACCOUNT} AS ACCOUNTNUM, {_DEPARTMENT} AS DEPARTMENT, "
            "SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1, 2"
        ),
        "balances_closed": (
            "SELECT * FROM balances UNION ALL "
            "SELECT '320100', 'ADMIN', -SUM(amount) FROM balances"
        ),
        "LEDGERBALANCE": _select(_LEDGER, "balances_closed", "TRUE"),
    }
    ctes["VENDTRANSOPEN"] = _select(PAYABLE_EXTRACT, "lineitem", "TRUE")
    ctes["CUSTTRANSOPEN_UNREADABLE"] = (
        f"SELECT * REPLACE ({UNREADABLE_AMOUNT} AS AMOUNTCUR) FROM CUSTTRANSOPEN"
    )
    for name, (base, variants) in EXTRACTS.items():
        ctes[name] = " UNION ALL ".join(_select(v, base, cond) for cond, v in variants)
    return ctes
