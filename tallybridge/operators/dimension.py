"""Join a large table to a dimension that is too large to broadcast, however uneven its keys are.

Keys that hold more than a share of one task's rows are found by counting; so there are few of them. Their rows
are dealt over lanes, and each of their dimension rows is copied to every lane. Unlike a flag on a key this carries
all columns, and dimension rows that share a key (doubled rows included) each meet every row of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.plans.spec import col
from tallybridge.session import materialise

#: A key is split if it has more than this share of the rows that a task has on average; a lane takes the other share.
SPLIT_SHARE, LANE_SHARE = 1 / 4, 1 / 64


def frequent_keys(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """(frequent_key, lanes) of the keys to split: fewer than ``tasks / SPLIT_SHARE``, by counting."""
    counts = materialise(rows.where(col(key).isNotNull()).groupBy(col(key).alias("frequent_key")).agg(F.count(F.lit(1)).alias("n_rows")))
    total = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    each = max(1.0, total / tasks)
    lanes = F.ceil(F.col("n_rows") / max(1.0, each * LANE_SHARE)).cast("bigint")
    return counts.where(F.col("n_rows") > each * SPLIT_SHARE).select("frequent_key", lanes.alias("lanes"))


def join_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    dimension_key: str,
    spread_by: Sequence[str],
    names: tuple[str, str] = ("s", "m"),
    tasks: int | None = None,
) -> DataFrame:
    """Inner join by shuffle, as aliases ``names``. ``spread_by`` names columns that tell rows apart.

    Null keys match nothing. Both sides move once.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = F.broadcast(frequent_keys(rows, key, tasks))
    lane = F.coalesce(F.pmod(F.xxhash64(*[col(c) for c in spread_by]), F.col("lanes")), F.lit(0).cast("bigint"))
    dealt = rows.join(frequent, col(key) == F.col("frequent_key"), "left").withColumn("lane", lane)
    dealt = dealt.drop("frequent_key", "lanes")
    last = F.coalesce(F.col("lanes"), F.lit(1)) - 1
    copied = dimension.join(frequent, col(dimension_key) == F.col("frequent_key"), "left")
    copied = copied.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("frequent_key", "lanes")
    left, right = (f"`{n}`." for n in names)
    on = F.expr(f"{left}`{key}` = {right}`{dimension_key}` AND {left}`lane` = {right}`lane`")
    return dealt.alias(names[0]).join(copied.hint("merge").alias(names[1]), on)
