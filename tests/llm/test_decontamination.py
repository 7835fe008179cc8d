import random
import re
import time
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybridge.llm import decontamination as D

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def plain_tiles(pattern, text, least):
    """Greedy string tiling by looking at every pair of positions."""
    used_p, used_t, out = set(), set(), []
    while True:
        best, found = least, []
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n] and p + n not in used_p and t + n not in used_t:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best:
                    found.append((p, t))
        if not found:
            return out
        for p, t in found:
            if not used_p & set(range(p, p + best)) and not used_t & set(range(t, t + best)):
                used_p |= set(range(p, p + best))
                used_t |= set(range(t, t + best))
                out.append((p, t, best))


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def plain_matches(docs, items, coverage=D.COVERAGE):
    out = set()
    seeds = defaultdict(set)
    for i, t in items:
        w = tokens(t)
        for j in range(len(w) - D.SEED + 1):
            seeds[tuple(w[j : j + D.SEED])].add((i, t))
    for d, t in docs:
        w = tokens(t)
        near = set().union(*(seeds.get(tuple(w[j : j + D.SEED]), set()) for j in range(len(w) - D.SEED + 1)), set())
        for i, item in near:
            p = tokens(item)
            covered = sum(n for _, _, n in D.tiles(p, w, D.SEED))
            if covered >= coverage * len(p):
                out.add((d, i, len(p), covered))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=18), st.integers(1, 4))
def test_tiles_are_greedy_string_tiling(pattern, text, least):
    assert D.tiles(pattern, text, least) == plain_tiles(pattern, text, least)


def test_copies_reordered_passages_and_marks(spark, documents):
    words = ITEM.split()
    rows = [
        (1, "before " + ITEM + " after"),
        (2, " ".join(words[10:] + ["between"] + words[:10])),
        (3, "** ".join(w.upper() for w in words)),
        (4, " ".join(words[:9])),
        (5, " ".join(words[:6]) + " x " + " ".join(words[7:13]) + " y " + " ".join(words[14:])),
        (6, " ".join(w for pair in zip(words, "abcdefghijklmnopqrst") for w in pair)),
        (7, None),
        (8, (ITEM + " ") * 50),
    ]
    items = spark.createDataFrame([(70, ITEM), (71, "four words only here"), (72, None), (73, "")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(documents(rows), items).collect()}
    assert set(got) == {(1, 70), (2, 70), (3, 70), (5, 70), (8, 70)}
    assert got[2, 70]["tiles"] == 2 and got[2, 70]["coverage"] == 1.0
    assert got[5, 70]["covered_words"] == 18
    assert got[8, 70]["covered_words"] == 20


def test_copies_with_marks_of_any_script(spark, documents):
    words = ITEM.split()
    chinese = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    rows = [
        (1, "\u00a0".join(words)),
        (2, "\u2014".join(words)),
        (3, "\u201c" + "\u201d \u201c".join(words) + "\u201d"),
        (4, "\u3000\u2028".join(w.upper() for w in words)),
        (5, "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else " " for c in ITEM)),  # full width
        (6, " ".join(w[:2] + "\u00ad" + w[2:] for w in words)),  # soft hyphens
        (7, "\u200b".join(words)),
        (8, "前文。" + chinese + "后文"),
        (9, "，".join(chinese)),
        (10, "天地玄黄宇宙洪荒日月盈昃辰宿列张"),
        (11, " ".join("\u00e9" + w for w in words)),
    ]
    items = spark.createDataFrame([("greek", ITEM), ("poem", chinese), (None, "r\u00e9sum\u00e9 na\u00efve fa\u00e7ade d\u00e9j\u00e0 vu caf\u00e9")], "item_id string, text string")
    nfd = "re\u0301sume\u0301 nai\u0308ve fac\u0327ade de\u0301ja\u0300 vu cafe\u0301"
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(documents([*rows, (12, nfd)]), items).collect()}
    assert got == {(i, "greek") for i in range(1, 8)} | {(8, "poem"), (9, "poem"), (12, None)}
    left = D.remove_contaminated(documents(rows), items)
    assert {r["doc_id"] for r in left.collect()} == {10, 11}


def test_letters_and_digits_are_kept():
    assert D.folded("Grün, ñandú №5 … «x» हिन्दी 🙂ok").split() == "grün ñandú no5 x हिन्दी ok".encode().split()
    assert D.folded("日本語abc").split() == ["日".encode(), "本".encode(), "語".encode(), b"abc"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=30))
def test_the_short_way_of_folding_is_the_long_one(text):
    assert D.folded(text).split() == D._folded(text).split()
    assert all(D.folded(chr(i)).split() == D._folded(chr(i)).split() for i in range(256))


def test_a_megabyte_of_one_word_is_tiled_in_time():
    begin = time.time()
    item = ["word"] * 72
    text = ["word"] * 200_000
    found = D.tiles(item, text, 5)
    assert found == [(0, 0, 72)] and time.time() - begin < 20
    matcher = D.Matcher([(1, " ".join(item))], D.SEED, D.COVERAGE)
    assert list(matcher.of([" ".join(text)])) == [[(0, 72, 1)]]


@pytest.mark.parametrize("piece, block", [(1 << 20, 4_000_000), (300, 200)])
def test_against_brute_force(spark, sf_dir, monkeypatch, piece, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = plain_matches(pairs, [tuple(r) for r in items.collect()])
    assert want
    if piece < 1 << 20:  # long texts in pieces, hashed in this process
        monkeypatch.setattr(D, "PIECE", piece)
        m = D.Matcher([tuple(r) for r in items.collect()], D.SEED, D.COVERAGE)
        found = zip(pairs, m.of([t for _, t in pairs]))
        assert {(d, m.ids[k], len(m.items[k]), n) for (d, _), hits in found for k, n, _ in hits} == want
    got = D.contaminated(docs, items, block_chars=block).collect()
    assert {(r["doc_id"], r["item_id"], r["item_words"], r["covered_words"]) for r in got} == want
    assert len(got) == len(want)
    left = D.remove_contaminated(docs, items, block_chars=block)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in pairs} - {w[0] for w in want}


def test_random_mixtures(spark, documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 25)))) for i in range(30)]
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w))
            parts += w[a : a + rng.randint(3, 20)] + rng.choices(words, k=rng.randint(0, 3))
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(parts)))
    got = D.contaminated(documents(rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"], r["item_words"], r["covered_words"]) for r in got.collect()} == plain_matches(rows, items)


def test_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(1, "the quiet river walks under the stone")], "item_id bigint, text string")
    docs = awkward.withColumn("item_id", F.lit(9))
    assert sorted(r["doc_id"] for r in D.contaminated(docs, items).collect()) == [6, 6, 7]
    assert D.remove_contaminated(docs, items).columns == docs.columns
    assert D.remove_contaminated(docs, items).count() == 13
    assert D.contaminated(docs, items.where("false")).count() == 0
    assert D.remove_contaminated(docs, items.where("false")).count() == 16
    assert D.contaminated(docs.where("false"), items).count() == 0
