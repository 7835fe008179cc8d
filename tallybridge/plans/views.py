"""Compatibility views: the old report schema on top of the new system's exported tables.

Each view is declared once as output column -> Spark SQL expression. The declaration serves both
the DataFrame functions and the ``CREATE OR REPLACE VIEW`` statements.

Companies are translated by ``company_map``. :func:`build_views` counts its rows and broadcasts it
while they are few; a larger one is joined by a shuffle that splits companies with many rows. In the created views the decision is
Spark's, from the size of the stored table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions.rules import LOCAL_CURRENCY
from tallybridge.operators.dimension import join_dimension

COMPANY = "`$Company`"


def _currency(column: str) -> str:
    return f"coalesce(nullif({column}, ''), '{LOCAL_CURRENCY}')"


@dataclass(frozen=True)
class View:
    """``columns`` over table ``base`` (alias s) joined with the company map (alias m)."""

    base: str
    columns: Mapping[str, str]


# Output columns of the old schema and the fields they are read from.
CUSTTABLE = View(
    "Customer_18",
    {
        "ACCOUNTNUM": "s.`No-1`",
        "NAME": "s.`Name-2`",
        "CUSTGROUP": "s.`CustomerPostingGroup-21`",
        "CURRENCY": _currency("s.`CurrencyCode-22`"),
        "COUNTRYREGIONID": "s.`CountryRegionCode-35`",
        "BLOCKED": "CASE s.`Blocked-39` WHEN 'Invoice' THEN 1 WHEN 'All' THEN 2 ELSE 0 END",
        "DATAAREAID": "m.DATAAREAID",
    },
)
CUSTTRANS = View(
    "CustLedgerEntry_21",
    {
        "ACCOUNTNUM": "s.`CustomerNo-3`",
        "NAME": "s.`CustomerName-8`",
        "CUSTGROUP": "s.`CustomerPostingGroup-22`",
        "DATAAREAID": "m.DATAAREAID",
        "TRANSDATE": "CAST(s.`PostingDate-4` AS DATE)",
        "VOUCHER": "s.`DocumentNo-6`",
        "INVOICE": "CASE WHEN s.`DocumentType-5` = 'Invoice' THEN s.`DocumentNo-6` END",
        "TXT": "s.`Description-7`",
        "TRANSTYPE": "upper(s.`DocumentType-5`)",
        "CURRENCYCODE": _currency("s.`CurrencyCode-11`"),
        "AMOUNTCUR": "coalesce(d.initial_amount, 0BD)",
        "SETTLEAMOUNTCUR": "-coalesce(d.applied_amount, 0BD)",
        "DIMENSION": "s.`GlobalDimension1Code-23`",
        "DIMENSION2_": "s.`GlobalDimension2Code-24`",
        "DUEDATE": "CAST(s.`DueDate-37` AS DATE)",
        "DOCUMENTDATE": "CAST(s.`DocumentDate-62` AS DATE)",
        "RECID": "s.`EntryNo-1`",
    },
)
BANKACCOUNTTRANS = View(
    "BankAccountLedgerEntry_271",
    {
        "ACCOUNTID": "s.`BankAccountNo-3`",
        "DATAAREAID": "m.DATAAREAID",
        "TRANSDATE": "CAST(s.`PostingDate-4` AS DATE)",
        "VOUCHER": "s.`DocumentNo-6`",
        "TXT": "s.`Description-7`",
        "CURRENCYCODE": _currency("s.`CurrencyCode-11`"),
        "AMOUNTCUR": "s.`Amount-13`",
        "RECONCILED": "CASE WHEN s.`Open-36` THEN 0 ELSE 1 END",
        "RECID": "s.`EntryNo-1`",
    },
)
LEDGERTRANS = View(
    "GLEntry_17",
    {
        "ACCOUNTNUM": "s.`GLAccountNo-3`",
        "DATAAREAID": "m.DATAAREAID",
        "TRANSDATE": "CAST(s.`PostingDate-4` AS DATE)",
        "VOUCHER": "s.`DocumentNo-6`",
        "TXT": "s.`Description-7`",
        "AMOUNTMST": "s.`Amount-17`",
        "CREDITING": "CASE WHEN s.`Amount-17` < 0 THEN 1 ELSE 0 END",
        "RECID": "s.`EntryNo-1`",
    },
)
CUSTTRANSOPEN_COLUMNS = {
    "ACCOUNTNUM": "ACCOUNTNUM",
    "DATAAREAID": "DATAAREAID",
    "REFRECID": "RECID",
    "TRANSDATE": "TRANSDATE",
    "DUEDATE": "DUEDATE",
    "CURRENCYCODE": "CURRENCYCODE",
    "AMOUNTCUR": "round(AMOUNTCUR - SETTLEAMOUNTCUR, 2)",
}
OPEN_BALANCE = "round(AMOUNTCUR - SETTLEAMOUNTCUR, 2) <> 0"
VIEWS = ("CUSTTABLE", "CUSTTRANS", "CUSTTRANSOPEN", "BANKACCOUNTTRANS", "LEDGERTRANS")
# Table of the export -> name under which its unmapped rows are listed.
DQ_TABLES = {
    "Customer_18": "Customer",
    "CustLedgerEntry_21": "CustLedgerEntry",
    "BankAccountLedgerEntry_271": "BankAccountLedgerEntry",
    "GLEntry_17": "GLEntry",
}
INITIAL, APPLIED = "Initial Entry", "Application"
# Largest company map that is broadcast, in rows.
MAP_ROWS = 100_000
_DETAIL_SUM = "coalesce(sum(`Amount-7`) FILTER (WHERE `EntryType-3` = '{kind}'), 0BD)"

Tables = Mapping[str, DataFrame]


def _project(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return rows.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def _mapped(base: str) -> str:
    """Name under which a table may be given joined to the company map already."""
    return f"{base} with company"


def _with_company(tables: Tables, base: str) -> DataFrame:
    if _mapped(base) in tables:
        return tables[_mapped(base)]
    return tables[base].alias("s").join(
        tables["company_map"].alias("m"), F.expr(f"m.CompanyName = s.{COMPANY}")
    )


def custtable(tables: Tables) -> DataFrame:
    return _project(_with_company(tables, CUSTTABLE.base), CUSTTABLE.columns)


def detail_amounts(tables: Tables) -> DataFrame:
    """Initial and applied amount per customer ledger entry, summed over its details."""
    return (
        tables["DetailedCustLedgEntry_379"]
        .groupBy(F.expr("`CustLedgerEntryNo-2`").alias("entry_no"), F.expr(COMPANY).alias("company"))
        .agg(
            F.expr(_DETAIL_SUM.format(kind=INITIAL)).alias("initial_amount"),
            F.expr(_DETAIL_SUM.format(kind=APPLIED)).alias("applied_amount"),
        )
    )


def custtrans(tables: Tables) -> DataFrame:
    rows = _with_company(tables, CUSTTRANS.base).join(
        detail_amounts(tables).alias("d"),
        F.expr(f"d.entry_no = s.`EntryNo-1` AND d.company = s.{COMPANY}"),
        "left",
    )
    return _project(rows, CUSTTRANS.columns)


def custtransopen(tables: Tables) -> DataFrame:
    return _project(custtrans(tables).filter(OPEN_BALANCE), CUSTTRANSOPEN_COLUMNS)


def bankaccounttrans(tables: Tables) -> DataFrame:
    return _project(_with_company(tables, BANKACCOUNTTRANS.base), BANKACCOUNTTRANS.columns)


def ledgertrans(tables: Tables) -> DataFrame:
    return _project(_with_company(tables, LEDGERTRANS.base), LEDGERTRANS.columns)


def dq_unmapped_companies(tables: Tables, checked: Mapping[str, str] = DQ_TABLES) -> DataFrame:
    """Rows per table and company that the views leave out for want of a company code.

    Rows are counted per company first, so that only a handful of counts meets the map.
    """
    counts = None
    for table, label in checked.items():
        part = (
            tables[table]
            .groupBy(F.expr(COMPANY).alias("CompanyName"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(label).alias("SourceTable"), "CompanyName", "n")
        )
        counts = part if counts is None else counts.unionByName(part)
    return (
        counts.alias("c")
        .join(tables["company_map"].alias("m"), F.expr("m.CompanyName = c.CompanyName"), "left")
        .filter("m.DATAAREAID IS NULL")
        .groupBy("c.SourceTable", "c.CompanyName")
        .agg(F.sum("c.n").alias("ROWS_EXCLUDED"))
    )


VIEW_FUNCTIONS = {
    "CUSTTABLE": custtable,
    "CUSTTRANS": custtrans,
    "CUSTTRANSOPEN": custtransopen,
    "BANKACCOUNTTRANS": bankaccounttrans,
    "LEDGERTRANS": ledgertrans,
    "DQ_UNMAPPED_COMPANIES": dq_unmapped_companies,
}


class LazyFrames(Mapping):
    """DataFrames by name, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def is_small(df: DataFrame, max_rows: int = MAP_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAP_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast if counting shows that it has at most ``max_rows`` rows."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def _join_company(tables: Tables, base: str) -> DataFrame:
    rows = tables[base]
    return join_dimension(rows, tables["company_map"], COMPANY.strip("`"), "CompanyName", [rows.columns[0]])


def build_views(tables: Tables, max_rows: int = MAP_ROWS) -> Mapping[str, DataFrame]:
    """All views over the tables, by view name. A company map of more than ``max_rows`` rows is joined by
    a shuffle in which companies with many rows are split (see ``operators.dimension``)."""
    sides = {name: partial(tables.__getitem__, name) for name in tables}
    if is_small(tables["company_map"], max_rows):
        sides["company_map"] = lambda: F.broadcast(tables["company_map"])
    else:
        for view in (CUSTTABLE, CUSTTRANS, BANKACCOUNTTRANS, LEDGERTRANS):
            if view.base in tables:
                sides[_mapped(view.base)] = partial(_join_company, tables, view.base)
    measured = LazyFrames(sides)
    return LazyFrames({name: partial(view, measured) for name, view in VIEW_FUNCTIONS.items()})


def view_statements(schema: str = "ax", source: str = "dbo") -> dict[str, str]:
    """``CREATE OR REPLACE VIEW`` per view, in an order in which views may use earlier ones."""

    def cells(columns: Mapping[str, str]) -> str:
        return ",\n  ".join(f"{e} AS {c}" for c, e in columns.items())

    def mapped(view: View) -> str:
        return (
            f"SELECT\n  {cells(view.columns)}\nFROM {source}.{view.base} s\n"
            f"JOIN {source}.company_map m ON m.CompanyName = s.{COMPANY}"
        )

    sums = ", ".join(
        f"{_DETAIL_SUM.format(kind=k)} AS {c}"
        for k, c in ((INITIAL, "initial_amount"), (APPLIED, "applied_amount"))
    )
    details = (
        f"SELECT `CustLedgerEntryNo-2` AS entry_no, {COMPANY} AS company, {sums} "
        f"FROM {source}.DetailedCustLedgEntry_379 GROUP BY 1, 2"
    )
    counted = "\n  UNION ALL ".join(
        f"SELECT '{label}' AS SourceTable, {COMPANY} AS CompanyName, count(*) AS n "
        f"FROM {source}.{table} GROUP BY 2"
        for table, label in DQ_TABLES.items()
    )
    bodies = {
        "CUSTTABLE": mapped(CUSTTABLE),
        "CUSTTRANS": (
            f"{mapped(CUSTTRANS)}\nLEFT JOIN ({details}) d\n"
            f"  ON d.entry_no = s.`EntryNo-1` AND d.company = s.{COMPANY}"
        ),
        "CUSTTRANSOPEN": (
            f"SELECT\n  {cells(CUSTTRANSOPEN_COLUMNS)}\nFROM {schema}.CUSTTRANS\nWHERE {OPEN_BALANCE}"
        ),
        "BANKACCOUNTTRANS": mapped(BANKACCOUNTTRANS),
        "LEDGERTRANS": mapped(LEDGERTRANS),
        "DQ_UNMAPPED_COMPANIES": (
            f"SELECT c.SourceTable, c.CompanyName, sum(c.n) AS ROWS_EXCLUDED\n"
            f"FROM ({counted}) c\n"
            f"LEFT JOIN {source}.company_map m ON m.CompanyName = c.CompanyName\n"
            f"WHERE m.DATAAREAID IS NULL GROUP BY 1, 2"
        ),
    }
    return {n: f"CREATE OR REPLACE VIEW {schema}.{n} AS\n{b}" for n, b in bodies.items()}


def create_views(spark: SparkSession, schema: str = "ax", source: str = "dbo") -> list[str]:
    """Create the schema if it is missing and (re)create all views in it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    statements = view_statements(schema, source)
    for statement in statements.values():
        spark.sql(statement)
    return [f"{schema}.{name}" for name in statements]
