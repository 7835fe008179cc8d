import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import lattice_lm as M

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def prior():
    return M.vocabulary(PIECES)


def plain_sum(text, weight):
    """Probability of a text as the sum over all ways to cut it, one by one."""

    def rest(i):
        if i == len(text):
            return 1.0
        total = sum(weight[text[i:j]] * rest(j) for j in range(i + 1, len(text) + 1) if text[i:j] in weight)
        if text[i] not in weight:
            total += math.prod(weight[f"<0x{b:02X}>"] for b in text[i].encode()) * rest(i + 1)
        return total

    return rest(0)


@pytest.mark.parametrize("word", ["", "a", "the", "thorin", "ñé", "日x", "🙂", "zzqjk"])
def test_sum_over_all_segmentations(prior, word):
    pieces, logs = prior
    weight = dict(zip(pieces, np.exp(logs)))
    assert math.isclose(M.Lattice(pieces, logs).log_sum(word), math.log(plain_sum("▁" + word, weight)), abs_tol=1e-9)


def test_expected_uses(prior):
    """Expected uses are derivatives of the log sum by the log weights."""
    pieces, logs = prior
    into = [0.0] * len(pieces)
    M.Lattice(pieces, logs).expect("▁thorinñ", 2.0, into)
    for k in np.flatnonzero(np.array(into) > 1e-6)[:12]:
        moved = logs.copy()
        moved[k] += 1e-5
        change = (M.Lattice(pieces, moved).log_sum("thorinñ") - M.Lattice(pieces, logs).log_sum("thorinñ")) / 1e-5
        assert math.isclose(2 * change, into[k], rel_tol=1e-3, abs_tol=1e-6)


def test_weights_are_a_distribution(spark, prior):
    pieces, logs = prior
    assert math.isclose(np.exp(logs).sum(), 1.0)
    vocab = spark.createDataFrame([(b"the", 5), (b"other", 2), (b"unseen", 0)], "word binary, c bigint")
    learned = M.reestimate(vocab, 3, pieces, logs)
    assert math.isclose(np.exp(learned).sum(), 1.0)
    assert learned[pieces.index("▁the")] > logs[pieces.index("▁the")]


def plain_base(rows):
    tokens = {}
    for i, (doc_id, text, held_out) in enumerate(rows):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        tokens[i] = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    counts = Counter()
    ends = 0
    for i, (_, _, held_out) in enumerate(rows):
        if not held_out:
            counts.update(tokens[i])
            ends += 1
    total = sum(counts.values()) + ends
    floor = math.log10(total + 0.5 * (len(counts) + (ends > 0) + 1))
    base = lambda c: math.log10(c + 0.5) - floor
    return sorted(
        (str(d), h, len(tokens[i]) + 1, sum(counts[w] > 0 for w in tokens[i]) + (ends > 0), total, round(sum(base(counts[w]) for w in tokens[i]) + base(ends), 4))
        for i, (d, _, h) in enumerate(rows)
    )


@pytest.mark.parametrize("chunk", [40, 2_000_000])
def test_base_against_brute_force(spark, awkward, chunk):
    docs = awkward.withColumns({"held_out": M.in_fold(F.col("doc_id"), 5, 1), "score": F.lit("mine")})
    rows = [(r["doc_id"], r["text"], r["held_out"]) for r in docs.collect()]
    got = M.score(docs, PIECES, rounds=1, chunk_words=chunk).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == plain_base(rows)
    assert all(r["score"] < 0 for r in got)
    copies = [r["score"] for r in got if r["doc_id"] in (6, 7)]
    assert len(set(copies)) == 1 and len(copies) == 3


def test_empty_table(spark, awkward):
    docs = awkward.where("false").withColumn("held_out", F.lit(False))
    assert M.score(docs, PIECES).count() == 0
    held = awkward.where("doc_id = 5").withColumn("held_out", F.lit(True))
    r = M.score(held, PIECES).first()
    assert (r["n_known"], r["train_tokens"], r["n_tokens"]) == (0, 0, 3) and r["score"] < 0


def test_query(spark, sf_dir):
    got = M.op8_lattice_lm(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(d["doc_id"], d["text"], zlib.crc32(str(d["doc_id"]).encode()) % 5 == 1) for d in docs]
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == plain_base(rows)
    held = [r for r in got if r["held_out"]]
    # learned weights describe texts they have not seen better than the vocabulary's own
    schema = "doc_id bigint, text string, held_out boolean"
    unlearned = M.score(spark.createDataFrame(rows, schema), PIECES, rounds=0).where("held_out")
    assert sum(r["score"] for r in held) > unlearned.agg(F.sum("score")).first()[0]
    # words of the corpus are likelier than the same letters in another order
    text = max(held, key=lambda r: r["n_tokens"])["doc_id"]
    text = next(d["text"] for d in docs if d["doc_id"] == text)
    both = spark.createDataFrame([(-1, text, True), (-2, " ".join(w[::-1] for w in text.split()), True)], schema)
    all_docs = both.unionByName(spark.createDataFrame(rows, both.schema))
    score = {r["doc_id"]: r["score"] for r in M.score(all_docs, PIECES).where("doc_id < 0").collect()}
    assert score[-1] > score[-2]
