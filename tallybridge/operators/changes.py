"""What changed between two extracts or exports of a table, and loading only that.

Rows are compared by key and by a digest of all their columns. Each side is reduced to one row per key before it moves, both meet
in one group-by, and only keys with a change are kept. They are measured, so that the wide rows of both sides are
labelled without a shuffle while the changed keys are few (see ``keysets``). No table format with a change feed is needed.

A key is the unit of change: where a key has several rows, or a different number of them, all its old rows are replaced by all its new
ones. Null parts of a key are equal to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.operators.checksum import digest_bucket, digest_sum, key_digest
from tallybridge.operators.keysets import Budget, label_rows
from tallybridge.plans.spec import col
from tallybridge.session import materialise

INSERT, UPDATE, DELETE, SAME = "insert", "update", "delete", "same"
CHANGE = "change"
BUCKET = "key_bucket"
_KEY, _ROW = "change_key", "change_row"


def _digested(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with a digest of their key. Keys of one column are marked like those of several, so that a null is no text."""
    parts = [col(k) for k in keys]
    return rows.withColumn(_KEY, key_digest(parts if len(parts) > 1 else [*parts, F.lit("")]))


def _row_digest(columns: Sequence[str]) -> Column:
    return key_digest([*[col(c) for c in columns], F.lit("")])


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], budget: Budget = Budget()) -> DataFrame:
    """(change_key, n_rows, verdict) of keys that differ, and of frequent ones that do not."""
    sides = [
        _digested(rows, keys).select(_KEY, _row_digest(new.columns).alias(_ROW), F.lit(n).alias("in_new"))
        for rows, n in ((old, 0), (new, 1))
    ]
    is_new = F.col("in_new") == 1
    found = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(_KEY)
        .agg(
            F.count_if(~is_new).alias("n_old"),
            F.count_if(is_new).alias("n_new"),
            digest_sum(F.when(~is_new, F.col(_ROW))).alias("old_sum"),
            digest_sum(F.when(is_new, F.col(_ROW))).alias("new_sum"),
            digest_sum(F.when(~is_new, F.reverse(_ROW))).alias("old_tail"),
            digest_sum(F.when(is_new, F.reverse(_ROW))).alias("new_tail"),
        )
    )
    same = (F.col("n_old") == F.col("n_new")) & (F.col("old_sum") == F.col("new_sum")) & (F.col("old_tail") == F.col("new_tail"))
    verdict = (
        F.when(F.col("n_old") == 0, INSERT).when(F.col("n_new") == 0, DELETE).when(same, SAME).otherwise(UPDATE)
    )
    n_rows = F.greatest("n_old", "n_new").alias("n_rows")
    found = found.select(_KEY, n_rows, verdict.alias("verdict"))
    return found.where((F.col("verdict") != SAME) | (F.col("n_rows") > budget.hot_rows))


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str], budget: Budget = Budget()) -> DataFrame:
    """The rows that turn ``old`` into ``new``, with ``change``: inserted and updated rows as they are in
    ``new``, deleted ones as they were in ``old``.

    Both sides need the same columns, in any order. Empty sides are tables like any other.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    verdicts = materialise(changed_keys(old, new, keys, budget))
    spread = list(new.columns)

    def labelled(rows: DataFrame, *kinds: str) -> DataFrame:
        known = _digested(rows.select(*[col(c) for c in spread]), keys)
        found = label_rows(known, _KEY, verdicts, CHANGE, spread, budget)
        return found.where(F.col(CHANGE).isin(*kinds)).drop(_KEY)

    return labelled(new, INSERT, UPDATE).unionByName(labelled(old, DELETE))


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str], budget: Budget = Budget()) -> DataFrame:
    """``old`` after a change set: rows of the keys in it are replaced by its inserted and updated rows."""
    touched = _digested(changes, keys).groupBy(_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    verdicts = touched.withColumn("verdict", F.lit(True))
    known = label_rows(_digested(old, keys), _KEY, verdicts, "touched", list(old.columns), budget)
    kept = known.where("touched IS NULL").select(*[col(c) for c in old.columns])
    return kept.unionByName(changes.where(F.col(CHANGE) != DELETE).drop(CHANGE))


def write_keyed(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Store a table so that later loads can replace parts of it: partitioned by the first digits of its keys' digest."""
    stored = _digested(rows, keys).withColumn(BUCKET, digest_bucket(F.col(_KEY))).drop(_KEY)
    stored.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop(BUCKET)


def load_changes(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], budget: Budget = Budget()) -> list[str]:
    """Apply a change set to a table of :func:`write_keyed`. Only the buckets that hold a changed key are read and
    written again; returns them.

    The new buckets are computed and kept in the shared folder before any old one is replaced. A bucket that has no rows left is
    written without rows, so loading the same changes again gives the same table.
    """
    schema = spark.read.parquet(path).drop(BUCKET).schema
    columns = [col(c) for c in schema.names]
    changes = _digested(changes, keys).withColumn(BUCKET, digest_bucket(F.col(_KEY))).drop(_KEY)
    changes = materialise(changes)  # they may have been found by reading this table
    touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())  # two hex digits: 256 at most
    if not touched:
        return []
    stored = spark.read.schema(schema.add(BUCKET, "string")).parquet(path).where(F.col(BUCKET).isin(touched))
    after = apply_changes(stored.select(*columns), changes.select(*columns, CHANGE), keys, budget)
    after = _digested(after, keys).withColumn(BUCKET, digest_bucket(F.col(_KEY))).drop(_KEY)
    after = materialise(after)
    left = {r[0] for r in after.select(BUCKET).distinct().collect()}
    after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    for bucket in sorted(set(touched) - left):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{BUCKET}={bucket}")
    return touched
