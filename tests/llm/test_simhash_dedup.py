import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybridge.llm import simhash_dedup as S
from tallybridge.llm.components import stars


def plain_fingerprint(text, k=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, radius=3):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(codes))]


def crowd(seed, centres=3, each=120, far=200):
    rng = random.Random(seed)
    codes = {rng.getrandbits(64) for _ in range(far)}
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            codes.add(x)
    return sorted(codes)


def canonical(labels):
    names = {}
    return [names.setdefault(x, len(names)) for x in labels]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉ é\t\n\x0b\x1c\x85 ", max_size=60))
def test_fingerprint_is_the_definition(text):
    assert S.fingerprint_of(text) == plain_fingerprint(text)


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 101}" for i in range(3000))
    blocks = S.word_blocks
    monkeypatch.setattr(S, "word_blocks", lambda t: blocks(t, 500))
    assert S.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_all_components(seed):
    codes = crowd(seed)
    random.Random(seed).shuffle(codes)
    assert canonical(S.tree_links(codes, 3)) == canonical(plain_components(codes))


@pytest.mark.parametrize("tree_rows", [40, 100_000])
def test_shards_lose_no_link(spark, tree_rows):
    codes = crowd(9)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(c,) for c in signed], "code bigint").repartition(4)
    root = {r["node"]: r["root"] for r in stars(S.links(df, 3, tree_rows)).collect()}
    assert canonical(root.get(c, c) for c in signed) == canonical(plain_components(codes))


def test_components_of_chains_stars_and_circles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in stars(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 0 for i in range(1, 50)}, 201: 200, 202: 200}
    assert stars(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    docs = sorted(docs, key=lambda d: d["doc_id"])
    codes = [plain_fingerprint(d["text"]) for d in docs]
    roots = plain_components(codes)
    want = {(d["doc_id"], f"{c:016x}", docs[r]["doc_id"]) for d, c, r in zip(docs, codes, roots)}
    assert {tuple(r) for r in S.op4_simhash_dedup(spark, sf_dir).collect()} == want


def test_awkward_rows(spark, awkward):
    got = S.near_duplicates(awkward).collect()
    assert len(got) == 16
    blank = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in blank} == {1, 2, 3, None} and {r["component_id"] for r in blank} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7)} == {6}
    assert S.near_duplicates(awkward.where("false")).count() == 0


def test_one_document_of_each_group_stays(spark, awkward):
    docs = awkward.withColumns({"code": F.lit("x"), "component_id": F.lit(1), "fingerprint": F.lit(None).cast("string")})
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i is not None) == [-5, 1, 4, 5, 6, 8, 9, 10, 11, 2**62]
    assert ids.count(None) == 1 and {r["text"] for r in got if r["doc_id"] is None} == {"no id here"}
    assert S.keep_one(docs.where("false")).count() == 0
