"""Order-free checksum of a key.

A digest over all sorted keys needs them in one place. Here every key is hashed by itself and the
hashes are counted and added up: the result does not depend on order, a changed key, a lost key and
a doubled key all change it, and each task keeps two numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.plans.spec import col

# Part separator, marks before a part and for a missing one, digits of the md5 that are used.
SEPARATOR = "\x1f"
PART, NO_PART = "\x01", "\x02"
NO_KEY = "0" * 32
DIGEST_DIGITS = 12
BUCKET_DIGITS = 2


def key_digest(parts: Sequence[Column]) -> Column:
    """md5 of the key; a missing key has a digest that no text has.

    The parts of a composite key are marked and joined by a separator, so that no text equals a missing part.
    """
    if len(parts) == 1:
        return F.coalesce(F.md5(parts[0].cast("string").cast("binary")), F.lit(NO_KEY))
    marked = [F.coalesce(F.concat(F.lit(PART), p.cast("string")), F.lit(NO_PART)) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *marked).cast("binary"))


def digest_bucket(digest: Column) -> Column:
    """Bucket of a digest; checksums per bucket tell *where* two key sets differ."""
    return F.substring(digest, 1, BUCKET_DIGITS)


def digest_sum(digest: Column) -> Column:
    """Aggregate: sum of the leading digits of all digests (0 for none)."""
    number = F.conv(F.substring(digest, 1, DIGEST_DIGITS), 16, 10).cast("decimal(18,0)")
    return F.coalesce(F.sum(number), F.lit(0).cast("decimal(28,0)"))


def differing_keys(
    source: DataFrame, target: DataFrame, buckets: DataFrame | None = None
) -> DataFrame:
    """Keys whose number of rows differs between the sides, with the surplus on the source side.

    ``buckets`` (a ``bucket`` column, e.g. the failed rows of a bucketed checksum) restricts the
    search to those buckets.
    """
    keys = [col(c) for c in source.columns]
    sides = source.withColumn("surplus", F.lit(1)).union(target.withColumn("surplus", F.lit(-1)))
    if buckets is not None:
        sides = sides.withColumn("bucket", digest_bucket(key_digest(keys))).join(
            buckets.select("bucket"), "bucket", "left_semi"
        )
    return (
        sides.groupBy(*keys).agg(F.sum("surplus").alias("surplus")).filter(F.col("surplus") != 0)
    )
