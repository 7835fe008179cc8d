import hashlib
import random
from collections import Counter, deque

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallybridge.llm import token_alignment as A

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTE_OF = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PLAIN)}


def spelled(i, a):
    """Bytes of a byte-level id: printable bytes stand for themselves, the others for 256 and on."""
    return bytes(BYTE_OF[c] for c in a.id_to_token(i))


def plain(texts, tokenizers):
    """Every text encoded whole, every occurrence of a link written out."""
    a, b = tokenizers
    aligned = []
    for text in texts:
        if not text:
            aligned.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [spelled(i, a) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            aligned.append(None)
            continue
        groups, left, right, at_a, at_b = [], [], [], 0, 0
        rest_b = deque(zip(ids_b, bytes_b))
        for i, piece in zip(ids_a, bytes_a):
            left.append(i)
            at_a += len(piece)
            while rest_b and at_b < at_a:
                j, other = rest_b.popleft()
                right.append(j)
                at_b += len(other)
            if at_a == at_b:
                groups.append((left, right))
                left, right = [], []
        aligned.append((ids_a, ids_b, groups))
    counts = Counter()
    for found in aligned:
        if found:
            counts.update({(x, y) for left, right in found[2] for x in left for y in right})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for found in aligned:
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for left, right in found[2] for x in left for y in right]
        written = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in found[2])
        best = sum(counts[p] == most[p[0]] for p in links)
        sums = (len(found[0]), len(found[1]), len(found[2]), len(links), best, sum(counts[p] for p in links))
        out.append((*sums, hashlib.sha256(written.encode()).hexdigest()))
    return out


def check(rows, out, tokenizers):
    want = plain([t for _, t in rows], tokenizers)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == ["doc_id", *COLUMNS]
    key = lambda r: repr(r)
    assert sorted(got, key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)


TRICKY = [
    "a b",
    " a  b ",
    "tabs\tand\nlines \n  end ",
    "it's we'll THEY'RE 'tis 3.14 x=1; <|endoftext|> <s> <unk> </s> <0x0A>",
    "▁ literal ▁▁mark",
    "naïve façade — “quotes” … 日本語 の 文 🙂🏽 कि म é",
    "nul \x00 and \x7f bell \x07",
    "no break spaces　here ​ zero",
    "    four  spaces   and a    run",
    "word " * 300,
    "ab" * 3000,
    "\n\n\n",
    " ",
    "  ",
    "trailing blank ",
    "ﬁ ligature ½ ² Å Å",
    "﻿bom  line para\x85next\x1cfs",
]


def test_tricky_texts_against_whole_encodings(spark, documents, tokenizers):
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "日", "🙂", " ", " ", "  ", "\n", "\t", "'s", "1", "23", ".", "-", "▁", " ", "ing", "<s>"]
    rows = list(enumerate(TRICKY + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(150)]))
    rows += [(i + 1000, t) for i, t in rows[:20]] + [(9000 + i, "the very same hot text") for i in range(90)]
    check(rows, A.align_corpus(documents(rows, 7), BYTE_LEVEL, PIECES, chunk_pairs=200), tokenizers)


def test_awkward_rows(spark, awkward, tokenizers):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] != 8]
    short = awkward.where("doc_id is null or doc_id <> 8").withColumns({"N_A": F.lit("x"), "digest": F.lit(1), "id": F.lit(0), "copies": F.lit(2)})
    check(rows, A.align_corpus(short, BYTE_LEVEL, PIECES), tokenizers)


def test_long_text(spark, awkward, tokenizers):
    long = awkward.where("doc_id = 8")
    text = long.first()["text"]
    a, b = tokenizers
    row = A.align_corpus(long, BYTE_LEVEL, PIECES).first()
    assert (row["n_a"], row["n_b"]) == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))
    assert row["n_best"] <= row["n_links"] == row["count_sum"]


def test_empty_tables(spark, awkward):
    out = A.align_corpus(awkward.where("false"), BYTE_LEVEL, PIECES)
    assert out.columns == ["doc_id", *COLUMNS] and out.count() == 0
    blank = A.align_corpus(awkward.withColumn("text", F.lit(None).cast("string")), BYTE_LEVEL, PIECES)
    assert {tuple(r)[1:] for r in blank.collect()} == {(0, 0, 0, 0, 0, 0, "")} and blank.count() == awkward.count()


def test_both_joins_give_the_same(spark, documents):
    rows = [(i, "hot text here" if i % 3 else f"text number {i}") for i in range(60)]
    docs = documents(rows)
    named = docs.select(F.col("doc_id").alias("id"), F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("digest"))
    measured = named.select("digest").distinct().select("digest", F.length("digest").cast("long").alias("n"), F.hex("digest").alias("groups_sha256"))
    want = sorted(tuple(r) for r in A.with_measures(spark, named, measured, ["n"], "doc_id", 2.0).collect())
    assert len(want) == 60 and want == sorted(tuple(r) for r in A.with_measures(spark, named, measured, ["n"], "doc_id", 0.0).collect())


def test_query(spark, sf_dir, tokenizers):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, A.op13_token_alignment(spark, sf_dir), tokenizers)
