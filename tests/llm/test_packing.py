import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallybridge.llm import packing as P


def padding(histogram, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram.items())


@pytest.mark.parametrize("seed", range(60))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(0, 60): rng.randint(1, 9) for _ in range(rng.randint(1, 10))}
    k = rng.randint(1, 5)
    lengths = sorted(histogram)
    best = min(padding(histogram, [*c, lengths[-1]]) for m in range(k) for c in itertools.combinations(lengths[:-1], m))
    got = P.boundaries(histogram, k)
    assert len(got) <= k and got == sorted(set(got)) and padding(histogram, got) == best


def check_batches(rows, budget, total):
    seats = {(r["bucket"], r["batch"], r["slot"]) for r in rows}
    assert len(seats) == len(rows)
    assert sum(r["n_tokens"] for r in rows) == total
    for bucket in {r["bucket"] for r in rows}:
        room = max(1, budget // max(bucket, 1))
        n = sum(r["bucket"] == bucket for r in rows)
        got = sorted((r["batch"], r["slot"]) for r in rows if r["bucket"] == bucket)
        assert got == [(i // room, i % room) for i in range(n)]
    assert all(r["n_tokens"] <= r["bucket"] for r in rows)


@pytest.mark.parametrize("slab", [3, 1000])
def test_pieces_and_batches(spark, documents, slab):
    lengths = [None, 0, 1, 1, 1, 7, 7, 8, 9, 10, 11, 25, 30, 100]
    docs = documents([(i, "x" * (n or 0)) for i, n in enumerate(lengths)]).withColumns({"batch": F.lit("old"), "Slot": F.lit(5)})
    docs = docs.withColumn("n", F.element_at(F.array(*[F.lit(n).cast("int") for n in lengths]), (F.col("doc_id") + 1).cast("int")))
    out = P.pack(docs, F.col("n"), max_length=10, buckets=3, token_budget=24, slab_rows=slab)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "piece", "start", "n_tokens", "bucket", "batch", "slot"]
    rows = out.collect()
    check_batches(rows, 24, sum(n or 0 for n in lengths))
    by_doc = {i: sorted((r["piece"], r["start"], r["n_tokens"]) for r in rows if r["doc_id"] == i) for i in range(len(lengths))}
    assert by_doc[0] == by_doc[1] == [(0, 0, 0)]
    assert by_doc[11] == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert len(by_doc[13]) == 10


def test_awkward_rows(spark, awkward):
    rows = P.pack(awkward, P.n_words(F.col("text"))).collect()
    total = awkward.agg(F.sum(P.n_words(F.col("text")))).first()[0]
    check_batches(rows, P.TOKEN_BUDGET, total)
    assert total == 60_000 + sum([1, 1, 1, 2, 3, 8, 8, 8, 1, 9, 5, 4, 1, 4, 4, 2])
    empty = P.pack(awkward.where("false"), F.col("n_chars"))
    assert empty.count() == 0 and empty.columns[-6:] == ["piece", "start", "n_tokens", "bucket", "batch", "slot"]


def test_query(spark, sf_dir):
    rows = P.op7_packing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    lengths = {d["doc_id"]: len((d["text"] or "").encode().split()) + 1 for d in docs}
    check_batches(rows, P.TOKEN_BUDGET, sum(lengths.values()))
    histogram = {}
    for r in rows:
        histogram[r["n_tokens"]] = histogram.get(r["n_tokens"], 0) + 1
    assert sorted({r["bucket"] for r in rows}) == P.boundaries(histogram, P.BUCKETS)
