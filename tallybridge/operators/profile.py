"""Column profiles of text extracts.

A table is unpivoted to (column, value) and counted per distinct value, which is one scan and one
shuffle for all columns; copies of a value are combined before the shuffle. Every metric is then
derived from the value counts, so patterns are tested once per distinct value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.rules import EMAIL_PATTERN, trim
from tallybridge.operators.quarantine import SOURCE_ROW
from tallybridge.plans.spec import col

# Business key per extract, columns whose gaps are an issue, the name patterns that
# switch on a test, and the wording of the findings.
PROFILE_KEYS = {
    "CUSTTABLE": "ACCOUNTNUM",
    "VENDTABLE": "ACCOUNTNUM",
    "INVENTTABLE": "ITEMID",
    "CUSTTRANSOPEN": "RECID",
}
GAP_COLUMNS = ("CURRENCY", "UNITID", "CURRENCYCODE")
CODE_SUFFIX = "GROUP"
EMAIL_PART = "EMAIL"
SPACES = "with leading/trailing spaces"
MIXED_CASE = "mixed case codes"
BAD_EMAIL = "invalid e-mails"
MISSING = "missing values"
DUPLICATE_KEYS = "duplicate keys after trim/upper"


def value_counts(df: DataFrame, columns: Sequence[str], order: str = SOURCE_ROW) -> DataFrame:
    """``position, value, n, first_row`` for every distinct value (null included) of the columns.

    ``position`` is the place of the column in ``columns``.
    """
    cells = F.array(*[col(c).cast("string") for c in columns])
    return (
        df.select(F.col(order).alias("row"), F.posexplode(cells).alias("position", "value"))
        .groupBy("position", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
    )


def _count(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))


def column_metrics(df: DataFrame, table: str, order: str = SOURCE_ROW) -> DataFrame:
    """One row per column: rows, nulls, distinct values, first value and the issue counts."""
    columns = [c for c in df.columns if c != order]
    position, value = F.col("position"), F.col("value")
    stripped = trim(value)
    is_code = position.isin([i for i, c in enumerate(columns) if c.endswith(CODE_SUFFIX)])
    is_email = position.isin([i for i, c in enumerate(columns) if EMAIL_PART in c])
    found = (
        value_counts(df, columns, order)
        .groupBy("position")
        .agg(
            F.sum("n").alias("n_rows"),
            _count(value.isNull()).alias("n_null"),
            F.count("value").alias("n_distinct"),
            F.min_by("value", F.when(value.isNotNull(), F.col("first_row"))).alias("sample"),
            _count(value != stripped).alias("n_spaces"),
            F.coalesce(F.bool_or(is_code & (stripped != F.upper(stripped))), F.lit(False)).alias(
                "mixed_case"
            ),
            _count(is_email & ~value.rlike(EMAIL_PATTERN)).alias("n_bad_email"),
        )
    )
    # every column has a row, in an empty table too
    names = F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("position", "column")
    named = df.sparkSession.range(1).select(F.lit(table).alias("table"), names)
    counts = [c for c in found.columns if c.startswith("n_")]
    return (
        named.join(found, "position", "left")
        .na.fill(0, counts)
        .na.fill({"mixed_case": False})
        .select("table", "column", *found.columns)
    )


def _finding(n: str, text: str) -> Column:
    return F.when(F.col(n) > 0, F.concat_ws(" ", F.col(n).cast("string"), F.lit(text)))


def profile_columns(df: DataFrame, table: str, order: str = SOURCE_ROW) -> DataFrame:
    """Profile as a report: null share, distinct count, first value and the findings as text."""
    return column_metrics(df, table, order).select(
        "table",
        "position",
        "column",
        F.bround(F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")), 1).alias("null_pct"),
        "n_distinct",
        F.coalesce("sample", F.lit("")).alias("sample"),
        F.concat_ws(
            "; ",
            _finding("n_spaces", SPACES),
            F.when(F.col("mixed_case"), MIXED_CASE),
            _finding("n_bad_email", BAD_EMAIL),
        ).alias("flags"),
    )


def approximate_columns(
    df: DataFrame, table: str, order: str = SOURCE_ROW, rsd: float = 0.02
) -> DataFrame:
    """Null share and estimated distinct count without shuffling values (one small aggregate)."""
    columns = [c for c in df.columns if c != order]
    flat = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(col(c)).alias(f"filled_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(col(c), rsd).alias(f"distinct_{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.bround(
                    F.try_divide((F.col("n_rows") - F.col(f"filled_{i}")) * 100.0, F.col("n_rows")), 1
                ).alias("null_pct"),
                F.col(f"distinct_{i}").alias("n_distinct"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return flat.select(F.lit(table).alias("table"), F.explode(cells).alias("cell")).select(
        "table", "cell.*"
    )


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of each key after trim and upper; all null keys are one key."""
    per_key = df.groupBy(F.upper(trim(col(key).cast("string"))).alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(
        F.lit(table).alias("table"), F.lit(key).alias("column"), "n"
    )


def missing_values(
    df: DataFrame, table: str, columns: Sequence[str] = GAP_COLUMNS
) -> DataFrame:
    """Nulls in those of ``columns`` that the table has; one scan, no shuffle of rows."""
    present = [c for c in columns if c in df.columns]
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"gaps_{i}").alias("n")) for i, c in enumerate(present)]
    empty = "array<struct<column:string,n:bigint>>"
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(col(c).isNull()).alias(f"gaps_{i}") for i, c in enumerate(present)],
    )
    found = counts.select(F.explode(F.array(*cells).cast(empty)).alias("cell"))
    return found.select(F.lit(table).alias("table"), "cell.column", "cell.n")


def profile_issues(
    df: DataFrame,
    table: str,
    key: str | None = None,
    gap_columns: Sequence[str] = GAP_COLUMNS,
    order: str = SOURCE_ROW,
) -> DataFrame:
    """Findings of one table: ``table, column, issue, n`` (n is null for a yes/no finding)."""
    gap = F.col("column").isin(list(gap_columns))
    found = F.array(
        F.struct(F.lit(SPACES).alias("issue"), F.col("n_spaces").alias("n")),
        F.struct(F.lit(BAD_EMAIL).alias("issue"), F.col("n_bad_email").alias("n")),
        F.struct(F.lit(MISSING).alias("issue"), F.when(gap, F.col("n_null")).alias("n")),
    )
    counted = (
        column_metrics(df, table, order)
        .select("table", "column", "mixed_case", F.explode(found).alias("f"))
        .select("table", "column", "mixed_case", "f.issue", "f.n")
    )
    mixed = F.col("mixed_case") & (F.col("issue") == SPACES)
    issues = counted.select(
        "table",
        "column",
        F.explode(
            F.filter(
                F.array(
                    F.when(F.col("n") > 0, F.struct("issue", "n")),
                    F.when(
                        mixed,
                        F.struct(
                            F.lit(MIXED_CASE).alias("issue"), F.lit(None).cast("bigint").alias("n")
                        ),
                    ),
                ),
                lambda f: f.isNotNull(),
            )
        ).alias("f"),
    ).select("table", "column", "f.*")
    if key is None:
        return issues
    # the same counts per value as above, so that they are shuffled once
    columns = [c for c in df.columns if c != order]
    values = value_counts(df, columns, order).filter(F.col("position") == columns.index(key))
    per_key = values.groupBy(F.upper(trim(F.col("value"))).alias("key")).agg(F.sum("n").alias("n"))
    doubled = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).filter("n > 0")
    doubled = doubled.select(F.lit(table).alias("table"), F.lit(key).alias("column"), "n")
    return issues.unionByName(
        doubled.select("table", "column", F.lit(DUPLICATE_KEYS).alias("issue"), "n")
    )


def profile_tables(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str] = PROFILE_KEYS,
    order: str = SOURCE_ROW,
) -> DataFrame:
    """Findings of all tables, tables in name order."""
    out = None
    for name in sorted(tables):
        part = profile_issues(tables[name], name, keys.get(name), order=order)
        out = part if out is None else out.unionByName(part)
    return out
