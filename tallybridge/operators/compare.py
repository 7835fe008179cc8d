"""Compare two sides key by key with one aggregation instead of a join.

Rows of all sides are tagged, combined per key before the shuffle and meet in one group-by. A key
that is missing on one side shows as a null measure there, and no key can be skewed: after partial
aggregation a task sends at most one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame], partial_columns: bool = False) -> DataFrame:
    """Union by column name; with ``partial_columns`` a part may lack some (they are null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=partial_columns), parts)


def totals_by_side(sides: Mapping[str, DataFrame], keys: Sequence[str], measure: str) -> DataFrame:
    """``keys`` and one column per side with the sum of ``measure`` (null: key absent there)."""
    tagged = union_all(
        [
            rows.select(*keys, F.col(measure).alias("measure"), F.lit(side).alias("side"))
            for side, rows in sides.items()
        ]
    )
    return tagged.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("side") == s, F.col("measure"))).alias(s) for s in sides]
    )


def within(left: Column, right: Column, tolerance: float, strict: bool = False) -> Column:
    """True when both sides exist and differ by at most (strictly: less than) the tolerance."""
    gap = F.abs(left - right)
    limit = F.lit(tolerance).cast("decimal(18,4)")
    return F.coalesce(gap < limit if strict else gap <= limit, F.lit(False))
