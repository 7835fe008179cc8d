"""Packing by optimal length buckets: documents of like length share a batch, so that little is padded.

Documents are cut into pieces of at most ``MAX_LENGTH`` tokens. Over the histogram of all piece lengths a dynamic
program chooses the bucket boundaries that minimise padding. Inside each bucket, batches of a fixed
budget of padded tokens are filled in an order that a hash decides.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import staged, table, without

#: Tokens of the longest sequence. The histogram has no more lengths than this.
MAX_LENGTH = 2048
BUCKETS = 12
#: Padded tokens of a batch.
TOKEN_BUDGET = 65_536
#: Pieces that are ranked together. Any value gives batches of the same sizes.
SLAB_ROWS = 20_000


def n_words(text: Column) -> Column:
    """Words between ASCII white space and one end token, the length of a text in this query; null counts as empty."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Ascending upper bounds of at most ``buckets`` buckets with the least total padding.

    Exact: the cost of a bucket from one length to the next is known from prefix sums, and the best split of
    the first j lengths into k buckets moves up with j, so each layer is solved by divide and conquer. Ties
    go to the smaller split.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    many = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(counts * lengths)])

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        """Padding of a bucket of the lengths i to j - 1."""
        return lengths[j - 1] * (many[j] - many[i]) - (total[j] - total[i])

    n = len(lengths)
    best = np.array([0] + [int(cost(np.array([0]), j)[0]) for j in range(1, n + 1)], np.int64)
    splits = []
    for k in range(2, min(buckets, n) + 1):
        new, split = np.full(n + 1, np.iinfo(np.int64).max), np.zeros(n + 1, np.int64)
        todo = [(k, n, k - 1, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            padded = best[i] + cost(i, j)
            at = int(padded.argmin())
            new[j], split[j] = padded[at], i[at]
            todo += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        best = new
        splits.append(split)
    out, j = [], n
    for split in reversed(splits):
        out.append(int(lengths[j - 1]))
        j = int(split[j])
    out.append(int(lengths[j - 1]))
    return out[::-1]


def pack(
    docs: DataFrame,
    length: Column,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    slab_rows: int = SLAB_ROWS,
) -> DataFrame:
    """One row for each piece: the columns of ``docs`` (those named like a new one are replaced) and
    ``piece``, ``start`` and ``n_tokens`` of the piece, ``bucket`` (the length it is padded to), ``batch`` (numbered
    in each bucket from 0) and ``slot`` in the batch.

    A document of ``length`` n has ceil(n / max_length) pieces; a null, zero or negative length is one empty piece of
    length 0, which costs nothing and has its own bucket bounds like any other. All batches of a bucket hold
    max(1, token_budget // bucket) pieces but the last. Rows that are equal in all columns are told apart only by their slots.
    """
    new = ["piece", "start", "n_tokens", "bucket", "batch", "slot"]
    rows = without(docs, new).withColumn("__length", F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long"))
    n = F.greatest(F.ceil(F.col("__length") / max_length), F.lit(1)).cast("int")
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("piece").cast("long") * max_length
    rows = rows.withColumns({"start": start, "n_tokens": F.least(F.col("__length") - start, F.lit(max_length)).cast("int")})
    rows = staged(rows.drop("__length"), "pieces")
    histogram = {r["n_tokens"]: r["n"] for r in rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # max_length + 1 rows at most
    bounds = boundaries(histogram, buckets)
    if not bounds:
        return rows.withColumns({"bucket": F.lit(0), "batch": F.lit(0).cast("long"), "slot": F.lit(0)})
    bucket = reduce(lambda rest, b: F.when(F.col("n_tokens") <= b, b).otherwise(rest), bounds[-2::-1], F.lit(bounds[-1]))
    room = reduce(lambda rest, b: F.when(F.col("bucket") == b, max(1, token_budget // max(b, 1))).otherwise(rest), bounds, F.lit(1))

    # a rank in each bucket without gathering the bucket: ranks in slabs, after the sizes of the slabs before
    slabs = max(1, sum(histogram.values()) // slab_rows)
    keys = [F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant", "void")) and c != "text"]
    rows = rows.withColumns({"bucket": bucket, "__hash": F.xxhash64(*keys)})
    rows = rows.withColumn("__slab", F.pmod("__hash", F.lit(slabs)))
    sizes = rows.groupBy("bucket", "__slab").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("bucket").orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    order = Window.partitionBy("bucket", "__slab").orderBy("__hash", *keys)
    rows = rows.withColumn("__rank", F.row_number().over(order) - 1).join(sizes, ["bucket", "__slab"])
    at = F.col("__before") + F.col("__rank")
    rows = rows.withColumns({"batch": F.floor(at / room).cast("long"), "slot": F.pmod(at, room).cast("int")})
    return rows.select(*[c for c in rows.columns if c not in (*new, "__hash", "__slab", "__rank", "__before")], *new)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", n_words(F.col("text")).alias("length"))
    return pack(docs, F.col("length")).drop("length")
