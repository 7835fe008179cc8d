import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallybridge.llm import token_store as K
from tallybridge.session import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = K.Encoder(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def ids_of(data):
    return np.frombuffer(data, ENCODER.kind).tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", " ", "\n", "\t", "a", "B", "é", "1", "'s", "!", "...", "\x1c", "\x85", "\u200b", "日", "<|endoftext|>"]), max_size=16), st.sampled_from([1, 3, 1 << 20]))
def test_cuts_do_not_change_ids(parts, chars):
    text = "".join(parts)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(K, "PIECE_CHARS", chars)
        assert [ids_of(b"".join(ids)) for ids in ENCODER.encode([text, "a b", text])] == [plain_ids(t) for t in (text, "a b", text)]


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED", 10)
    encoder = K.Encoder(PATH)
    for i in range(30):
        text = " ".join(f"word{j}" for j in range(i, i + 8))
        assert ids_of(b"".join(next(encoder.encode([text])))) == plain_ids(text)


def test_many_texts_at_once():
    rng = random.Random(2)
    words = ["a", "the", "Straße", "日本", "x" * 90, "", "tab\t", "<|endoftext|>", "it's", "\n", "é", "12", "--"] + [f"new{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(300)] + ["", " ", "  ", " a", "a "]
    assert [ids_of(b"".join(ids)) for ids in K.Encoder(PATH).encode(texts)] == [plain_ids(t) for t in texts]
    assert list(K.Encoder(PATH).encode([])) == []


def test_folders_keep_their_file_system(spark, tmp_path):
    root = K._qualified(spark, str(tmp_path))
    assert root == f"file:{tmp_path}" and K._files(root)[1] == K._files(f"file://{tmp_path}")[1] == str(tmp_path)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 20_000])
def test_index_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    first, second, other = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(3))
    if n:
        seed, displacements, slots = K.build_mph(first, second)
        assert sorted(slots.tolist()) == list(range(n))
        assert len(displacements) <= n // K.BUCKET_KEYS + 1
    shard = K.IndexShard(K.IndexShard.dump(first, second, np.arange(n) % 5, np.arange(n) * 3, np.arange(n)))
    found, held = shard.find(first, second)
    assert held.all() and (found["offset"] == np.arange(n) * 3).all() and (found["shard"] == np.arange(n) % 5).all()
    assert shard.find(other, second)[1].sum() <= 1  # fingerprints of 32 bits


@pytest.mark.parametrize("shard_ids, index_keys", [(16_000_000, 32_768), (50, 3)])
def test_round_trip(spark, awkward, shard_ids, index_keys):
    docs = awkward.withColumns({"copy": F.lit("x"), "n": F.lit(1), "file": F.lit(None).cast("string")})
    root = new_folder(spark, "store")
    K.write_store(docs, PATH, root, shard_ids=shard_ids, index_keys=index_keys)
    keys = docs.groupBy("doc_id").count().select("doc_id", F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1)).alias("copy"))
    digest = lambda ids: (np.concatenate([*ids, np.zeros(0, "<u4")]).tolist(),)
    got = K.read_store(keys, root, "ids array<bigint>", digest).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got.sort(key=lambda r: r["start"])
    assert [(r["doc_id"], r["ids"]) for r in got] == [(i, plain_ids(t)) for i, t in rows]
    assert [r["start"] for r in got] == np.cumsum([0] + [len(plain_ids(t)) for _, t in rows])[:-1].tolist()
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)
    missing = spark.createDataFrame([(i, 0) for i in range(1000, 3000)] + [(6, 2), (1, 1)], "doc_id bigint, copy int")
    assert K.locate(missing, root).count() == 0


def test_files_are_raw_ids(spark, documents):
    root = new_folder(spark, "store")
    K.write_store(documents([(3, "c c"), (1, "a"), (2, None)], 1), PATH, root)
    row = spark.read.parquet(f"{root}/catalog").first()
    data = open(f"{root}/shards/{row['file']}".removeprefix("file://"), "rb").read()
    assert struct.unpack("<4sIQ", data[:16]) == (K.MAGIC, K.VERSION, 2)
    assert ids_of(data[16:]) == plain_ids("a") + plain_ids(None) + plain_ids("c c")


def test_empty_table(spark, awkward):
    root = new_folder(spark, "store")
    empty = awkward.where("false")
    K.write_store(empty, PATH, root)
    keys = spark.createDataFrame([(1, 0)], "doc_id bigint, copy int")
    assert K.read_store(keys, root, "ids_crc32 bigint", K.ids_crc32).count() == 0


def test_query(spark, sf_dir):
    got = sorted(tuple(r) for r in K.op3_token_store(spark, sf_dir).collect())
    want, start = [], 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = plain_ids(r["text"])
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert random.Random(0).choice(got)
