import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybridge.llm import lexical_search as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Brute force: every item against every document."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for row, (i, bag) in enumerate(bags):
            n = sum(bag.values())
            score = 0
            for t in words(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_terms_are_the_maximal_runs():
    text = "Ab-cd é1 x __ Straße ÀÉ\x00z\x7f日本 " * 3
    got = [w.decode() for part in L.terms(text.encode()) for w in part]
    assert got == words(text)
    long = "Word9 " * 400_000
    parts = list(L.terms(long.encode()))
    assert len(parts) > 1 and [w for p in parts for w in p] == [b"word9"] * 400_000
    assert list(L.terms(None)) == list(L.terms(b"")) == [] and list(L.terms(b"\x00 ,")) == [[]]


@pytest.mark.parametrize("seed,block,docs_below,items_below", [(1, 40, (12, 6, 2), (8, 4, 2)), (2, 10**6, L.DOC_LEVELS, L.ITEM_LEVELS), (3, 25, (30, 7, 3), (9, 3, 1))])
def test_against_all_pairs(spark, documents, seed, block, docs_below, items_below):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    word = lambda: vocabulary[min(59, int(rng.expovariate(0.08)))]
    hot = " ".join(word() for _ in range(40))
    docs = [(i, hot if i % 3 == 0 else " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(150)]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(25)]
    items += [(25, hot), (25, hot), (26, "w0 " * 30)]
    out = L.rank_documents(
        documents(docs, 6), spark.createDataFrame(items, ITEMS), k=4, block_terms=block, doc_levels=docs_below, item_levels=items_below
    )
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(out) == plain(docs, items, 4)


def test_awkward_rows(spark, awkward):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    items = [(1, "the QUIET river"), (2, None), (3, ""), (None, "two words, no id"), (5, "日本語 déjà 🙂"), (6, "absent"), (6, "x" * 50_000), (7, "id " * 2000 + "stone0 stone16")]
    bench = spark.createDataFrame(items, ITEMS).withColumns({"rank": F.lit("r"), "doc_id": F.lit(8)})
    out = L.rank_documents(awkward.withColumns({"score": F.lit(0.5), "item_id": F.lit(1)}), bench)
    assert found(out) == plain(docs, items)


def test_empty_tables(spark, awkward):
    bench = spark.createDataFrame([(1, "the quiet river")], ITEMS)
    blank = awkward.withColumn("text", F.lit(None).cast("string"))
    for docs, items in ((awkward, bench.where("false")), (awkward.where("false"), bench), (blank, bench), (awkward, bench.withColumn("text", F.lit("..")))):
        out = L.rank_documents(docs, items)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_text_ids(spark):
    rows = [("b", "one two"), ("a", "one two"), ("c", "three"), ("d", "four")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    out = L.rank_documents(docs, spark.createDataFrame([("q", "two")], "item_id string, text string"))
    assert [tuple(r)[:3] for r in out.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_bounds_prune_and_stay_exact():
    """One document that an item was made of: once it is known, other batches are left out unscored."""
    rng = random.Random(4)
    entries = [(i, 20 * i + t, rng.randint(50, 90)) for i in range(16) for t in range(20)]
    tree = L.ItemTree(entries, (8, 4, 2))
    docs = [[(20 * (d % 16) + t, 900) for t in range(20)] if d < 16 else [(rng.randrange(320), 100) for _ in range(3)] for d in range(400)]
    docs = [sorted(dict(d).items()) for d in docs]
    starts = np.cumsum([0, *map(len, docs)])
    columns, impacts = (np.array([e[j] for d in docs for e in d]) for j in (0, 1))
    ranking = L.Ranking(16, 1, np.ones(16, np.int64))
    arguments = (tree, ranking, list(range(400)), np.arange(400), starts, columns, impacts, (64, 16, 4))
    first = L.search_chunk(*arguments)
    again = L.search_chunk(*arguments)
    assert first < 16 * 400 / 2 and again < first
    scores = np.zeros((400, 16), np.int64)
    for d, entry in enumerate(docs):
        for i, column, w in entries:
            scores[d, i] += w * dict(entry).get(column, 0)
    for place, best in enumerate(ranking.best):
        i = tree.order[place]
        assert (-best[0][0], best[0][2]) == (scores[:, i].max(), int(scores[:, i].argmax()))


def test_very_heavy_items_stay_exact():
    """Sums beyond what doubles hold are worked out in 64-bit integers."""
    tree = L.ItemTree([(0, 0, 10**10), (0, 1, 1), (1, 1, 3)])
    assert tree.kind is np.int64
    ranking = L.Ranking(2, 1, np.ones(2, np.int64))
    L.search_chunk(tree, ranking, [1, 2], np.arange(2), np.array([0, 2, 4]), np.array([0, 1, 0, 1]), np.array([999_999, 7, 999_999, 8]))
    heavy = [b for i, b in enumerate(ranking.best) if tree.order[i] == 0][0]
    assert heavy == [(-(10**10 * 999_999 + 8), False, 2, 1)]
