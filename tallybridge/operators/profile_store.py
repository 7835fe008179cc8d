"""Profiles that add up: the profile of two deliveries together, without a second scan of either.

A stored profile has one row per column. Counts add up, the smallest and largest value are those of the parts, and what does not add up is
kept as a sketch: a HyperLogLog sketch of the distinct values and a KLL sketch of the numbers. Sketches of the parts merge into that
of the whole. A table is scanned once and no value is shuffled: each task sends one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.rules import EMAIL_PATTERN, WHITESPACE, trim
from tallybridge.operators.compare import union_all
from tallybridge.operators.profile import CODE_SUFFIX, EMAIL_PART
from tallybridge.operators.quarantine import SOURCE_ROW
from tallybridge.plans.spec import col

#: Binary logarithm of the registers of a distinct-count sketch, and the size of a quantile sketch. Estimates of distinct
#: values err by about 1.04 / sqrt(2 ** LG_REGISTERS) (1.6 %, twice that at 95 %); ranks of quantiles by about 1.3 %.
LG_REGISTERS, QUANTILE_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03
COUNTS = ("n_rows", "n_null", "n_spaces", "n_bad_email", "n_numbers", "n_mixed_case")
QUANTILES = (0.25, 0.5, 0.75)
#: Every text that a cast to double may read has this form; the cast decides. A cast of any other text fails by an exception, which takes
#: as long as all other measures of a value together.
NUMBER_FORM = (
    r"^[\x00-\x20]*[+-]?(?:[0-9.]+(?:[eE][+-]?[0-9]+)?[fFdD]?|0[xX][0-9a-fA-F.]+[pP][+-]?[0-9]+[fFdD]?"
    r"|[nN][aA][nN]|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)[\x00-\x20]*$"
)


def _number(value: Column) -> Column:
    return F.when(value.rlike(NUMBER_FORM), value.try_cast("double"))


def _has_spaces(value: Column) -> Column:
    """Whether trimming would change the value, from its first and last character."""
    return F.substring(value, 1, 1).isin(*WHITESPACE) | F.substring(value, -1, 1).isin(*WHITESPACE)


def _measures(name: str, at: int) -> list[Column]:
    value, number = F.col(f"value_{at}"), F.col(f"number_{at}")
    stripped = trim(value)
    is_number = number.isNotNull() & ~F.isnan(number)
    named = {
        "n_null": F.count_if(value.isNull()),
        "n_spaces": F.count_if(_has_spaces(value)),
        "n_bad_email": F.count_if(~value.rlike(EMAIL_PATTERN)) if EMAIL_PART in name else F.lit(0).cast("bigint"),
        "n_mixed_case": F.count_if(stripped != F.upper(stripped)) if name.endswith(CODE_SUFFIX) else F.lit(0).cast("bigint"),
        "n_numbers": F.count_if(is_number),
        "smallest": F.min(value),
        "largest": F.max(value),
        "distinct": F.hll_sketch_agg(value, LG_REGISTERS),
        "numbers": F.kll_sketch_agg_double(F.when(is_number, number), QUANTILE_K),
    }
    return [v.alias(f"{n}_{at}") for n, v in named.items()]


def stored_profile(df: DataFrame, table: str, order: str = SOURCE_ROW) -> DataFrame:
    """The mergeable profile of a table: one row per column, in an empty table too."""
    columns = [c for c in df.columns if c != order]
    # numbers are read in a projection of their own, once for all measures
    values = df.select(*[col(c).cast("string").alias(f"value_{i}") for i, c in enumerate(columns)])
    cast = values.select("*", *[_number(F.col(f"value_{i}")).alias(f"number_{i}") for i in range(len(columns))])
    flat = cast.agg(F.count(F.lit(1)).alias("n_rows"), *[m for i, c in enumerate(columns) for m in _measures(c, i)])
    names = ("n_null", "n_spaces", "n_bad_email", "n_mixed_case", "n_numbers", "smallest", "largest", "distinct", "numbers")
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, c in enumerate(columns)
    ]
    found = flat.select(F.lit(table).alias("table"), "n_rows", F.explode(F.array(*cells)).alias("cell"))
    return found.select("table", "cell.column", "n_rows", *[f"cell.{n}" for n in names])


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """The profile of all parts together. A column that only some parts have counts as null in the others."""
    parts = union_all(list(profiles))
    merged = parts.groupBy("table", "column").agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("numbers").alias("numbers"),
    )
    # rows of parts without the column: each part says its number of rows once for each of its columns
    totals = [p.groupBy("table").agg(F.max("n_rows").alias("all_rows")) for p in profiles]
    totals = union_all(totals).groupBy("table").agg(F.sum("all_rows").alias("all_rows"))
    merged = merged.join(totals, "table")
    missing = F.col("all_rows") - F.col("n_rows")
    return merged.withColumns({"n_null": F.col("n_null") + missing, "n_rows": F.col("all_rows")}).select(parts.columns)


def read_profile(stored: DataFrame) -> DataFrame:
    """A stored profile as a report: shares, the estimated number of distinct values, and quartiles of the numbers (null where there are none)."""
    quartiles = [
        F.when(F.col("n_numbers") > 0, F.kll_sketch_get_quantile_double("numbers", F.lit(q))).alias(f"q{round(q * 100)}")
        for q in QUANTILES
    ]
    return stored.select(
        "table",
        "column",
        "n_rows",
        F.bround(F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")), 1).alias("null_pct"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        "smallest",
        "largest",
        "n_spaces",
        (F.col("n_mixed_case") > 0).alias("mixed_case"),
        "n_bad_email",
        "n_numbers",
        *quartiles,
    )
