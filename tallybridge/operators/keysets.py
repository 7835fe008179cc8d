"""Label wide rows by a verdict on their key, shuffling them only if there is no other way.

Questions such as "is this key used twice?" or "does the parent exist?" are answered once per key
on a narrow projection: the group-by combines copies of a key before the shuffle, so one key that
owns a third of all rows costs one partial row per task. Only keys with something to report are
kept. That set is measured, and the rows are then labelled

* by a broadcast join while the set fits ``Budget``: the wide rows are not shuffled at all;
* beyond it, by broadcast for frequent keys (by counting, fewer than ``hot_keys`` keys can be that
  frequent) and by one shuffle of the rows for all others. Rows of frequent keys are answered
  before that shuffle; a lane spreads them over all partitions.

Both ways label every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallybridge.plans.spec import col, quoted
from tallybridge.session import materialise


@dataclass(frozen=True)
class Budget:
    """Largest verdict set that is broadcast whole, and the number of frequent keys split off."""

    rows: int = 1_000_000
    bytes: int = 64 << 20
    hot_keys: int = 100_000
    hot_rows: int = 1_000_000


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & col(a).eqNullSafe(col(b))
    return on


def _row_bytes(schema: StructType, parent: str = "") -> Column:
    """Upper estimate of the memory a row takes, from the lengths of its texts."""
    total = F.lit(16)
    for field in schema.fields:
        path = f"{parent}{quoted(field.name)}"
        if isinstance(field.dataType, StructType):
            total = total + _row_bytes(field.dataType, f"{path}.")
        elif isinstance(field.dataType, StringType):
            total = total + 16 + F.coalesce(F.octet_length(F.col(path)), F.lit(0))
        else:
            total = total + 16
    return total


@dataclass(frozen=True)
class Measured:
    """A materialised key set, its size and the number of rows that its keys stand for."""

    keys: DataFrame
    rows: int
    bytes: int
    labelled: int

    def fits(self, budget: Budget) -> bool:
        return self.rows <= budget.rows and self.bytes <= budget.bytes

    def is_hot(self, budget: Budget) -> Column:
        """True for keys with so many rows that there must be fewer than ``hot_keys`` of them."""
        return F.col("n_rows") > max(budget.hot_rows, self.labelled // budget.hot_keys)


def measure(keys: DataFrame) -> Measured:
    """Compute a key set (with its ``n_rows``) once and find out how large it is."""
    keys = materialise(keys)
    zero = F.lit(0).cast("bigint")
    size = keys.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(keys.schema)), zero).alias("bytes"),
        F.coalesce(F.sum("n_rows"), zero).alias("labelled"),
    ).first()
    return Measured(keys, size["rows"], size["bytes"], size["labelled"])


def lane(answered: Column, spread_by: Sequence[str]) -> Column:
    """-1 for rows that still need an answer, anything else for the others."""
    spread = F.pmod(F.xxhash64(*[col(c) for c in spread_by]), F.lit(1 << 40))
    return F.when(answered, spread).otherwise(F.lit(-1).cast("bigint"))


def position_of(order: Sequence[str]) -> Column:
    return col(order[0]) if len(order) == 1 else F.struct(*[col(c) for c in order])


def _first_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], names: Sequence[str]
) -> DataFrame:
    return (
        rows.groupBy(*[col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(position_of(order)).alias("first_position"))
        .filter(F.col("n_rows") > 1)
    )


def mark_repeats(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, budget: Budget
) -> DataFrame:
    """Add ``flag``: true for all rows of a key but its first. Null parts of a key are equal.

    If the position has several columns, they are looked at only in rows whose key is repeated (or
    frequent), so that the first shuffle carries keys and counts only.
    """
    names = [f"repeated_key_{i}" for i in range(len(keys))]
    on = _null_safe(keys, names)
    if len(order) == 1:
        counted = firsts = measure(_first_rows(rows, keys, order, names))
    else:
        counted = measure(
            rows.groupBy(*[col(k).alias(n) for k, n in zip(keys, names)])
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .filter("n_rows > 1")
        )
        found = counted.keys if counted.fits(budget) else counted.keys.filter(counted.is_hot(budget))
        candidates = rows.join(F.broadcast(found.select(*names)), on, "left_semi")
        firsts = measure(_first_rows(candidates, keys, order, names))

    whole = counted.fits(budget) and firsts.fits(budget)
    known = firsts.keys if whole else firsts.keys.filter(counted.is_hot(budget))
    labelled = rows.join(
        F.broadcast(known.select(*names, "first_position")), on, "left"
    ).drop(*names)
    answered = F.col("first_position").isNotNull()
    is_later = answered & ~position_of(order).eqNullSafe(F.col("first_position"))
    if whole:
        return labelled.withColumn(flag, is_later).drop("first_position")

    in_key = Window.partitionBy(*[col(k) for k in keys], "row_lane").orderBy(
        *[col(c) for c in order]
    )
    return (
        labelled.withColumn("row_lane", lane(answered, order))
        .withColumn("row_in_key", F.row_number().over(in_key))
        .withColumn(flag, F.when(answered, is_later).otherwise(F.col("row_in_key") > 1))
        .drop("row_lane", "row_in_key", "first_position")
    )


def unmatched_keys(
    rows: DataFrame, key: str, parents: DataFrame, parent_key: str, budget: Budget = Budget()
) -> DataFrame:
    """Keys without a parent (a null key has none), plus the frequent keys that have one.

    Frequent keys are kept so that :func:`label_rows` can take their rows out of a shuffle.
    """
    known = parents.select(col(parent_key).alias("parent_key")).distinct()
    per_key = rows.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n_rows"))
    orphan = F.col("parent_key").isNull()
    return (
        per_key.join(known, col(key) == F.col("parent_key"), "left")
        .filter(orphan | (F.col("n_rows") > budget.hot_rows))
        .select(col(key), "n_rows", orphan.alias("verdict"))
    )


def label_rows(
    rows: DataFrame,
    key: str,
    verdicts: DataFrame,
    label: str,
    spread_by: Sequence[str],
    budget: Budget = Budget(),
) -> DataFrame:
    """Add ``label``: the verdict on the row's key, null where the key has none.

    ``spread_by`` names columns that tell rows apart.
    """
    measured = measure(verdicts.select(col(key).alias("verdict_key"), "n_rows", "verdict"))
    verdicts, on = measured.keys, _null_safe([key], ["verdict_key"])
    if measured.fits(budget):
        found = verdicts.select("verdict_key", F.col("verdict").alias(label))
        return rows.join(F.broadcast(found), on, "left").drop("verdict_key")

    hot = verdicts.filter(measured.is_hot(budget)).select(
        "verdict_key", F.col("verdict").alias("hot_verdict")
    )
    # The lane is always -1 here, but not a constant: a constant would be folded into the join
    # condition, and the lane would no longer take part in the partitioning.
    cold = verdicts.filter(~measured.is_hot(budget)).select(
        F.col("verdict_key").alias("cold_key"),
        F.least(F.col("n_rows"), F.lit(-1)).cast("bigint").alias("cold_lane"),
        F.col("verdict").alias("cold_verdict"),
    )
    answered = F.col("hot_verdict").isNotNull()
    same_lane = F.col("row_lane") == F.col("cold_lane")
    return (
        rows.join(F.broadcast(hot), on, "left")
        .drop("verdict_key")
        .withColumn("row_lane", lane(answered, spread_by))
        .join(cold, _null_safe([key], ["cold_key"]) & same_lane, "left")
        .withColumn(label, F.coalesce("hot_verdict", "cold_verdict"))
        .drop("row_lane", "hot_verdict", "cold_key", "cold_lane", "cold_verdict")
    )
