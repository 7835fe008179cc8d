"""The pipeline against a brute-force version of each stage, with planted cases."""

import importlib.util
import os
import random
import re

import pytest
from pyspark.sql import functions as F

spec = importlib.util.spec_from_file_location("corpus_pipeline", os.path.join(os.path.dirname(__file__), "..", "..", "corpus_pipeline.py"))
P = importlib.util.module_from_spec(spec)
spec.loader.exec_module(P)

from tallybridge.llm import packing  # noqa: E402
from tallybridge.llm.simhash_dedup import fingerprint_of  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage gets and gives, over the smallest tables with rows planted on top."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    rng = random.Random(3)
    base = max((r["text"] for r in docs.where("lang = 'en'").collect()), key=len)
    item = max((r["text"] for r in bench.collect()), key=len)
    words = item.split()
    near = base.split(" ")
    near[len(near) // 2] = "changed"
    rows = [
        (900_001, base, "en"),
        (900_002, " ".join(near), None),
        (900_003, "1234 5678 ... 90", "en"),
        (900_004, None, None),
        (900_005, "", "en"),
        (900_006, "And then. " + item + " the of the", "en"),
        (900_007, " ".join(words[len(words) // 2 :] + ["the", "of"] + words[: len(words) // 2]), "en"),
        (900_008, "The token = \"" + "".join(rng.choices("0123456789abcdef", k=40)) + "\" of and the inthe ther", "en"),
        (900_009, "Anin the of there and onth ing thereof in anon the withon thering", "en"),
    ]
    more = spark.createDataFrame([(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in rows], docs.schema)
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    df, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        out = P.staged(stage(spark, df, folder), f"test-{name}")
        seen.append((name, [r.asDict() for r in df.collect()], [r.asDict() for r in out.collect()], out.columns))
        df = out
    return {name: (before, after, columns) for name, before, after, columns in seen}, folder


def test_names_and_columns(stages):
    seen, _ = stages
    assert list(seen) == ["language_id", "simhash_dedup", "decontamination", "secret_scan", "packing"]
    assert all(seen[n][2] == COLUMNS for n in list(seen)[:-1])


def test_language_id(stages):
    before, after, _ = stages[0]["language_id"]
    kept = {r["doc_id"] for r in after}
    assert {r["doc_id"] for r in before} - kept == {900_003, 900_004, 900_005}
    assert [r for r in before if r["doc_id"] in kept and r not in after] == []


def test_simhash_dedup(stages):
    before, after, _ = stages[0]["simhash_dedup"]
    rows = sorted(before, key=lambda r: r["doc_id"])
    codes = [fingerprint_of(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(r["doc_id"] for r in after) == [rows[i]["doc_id"] for i in range(len(rows)) if find(i) == i]
    assert not {900_001, 900_002} & {r["doc_id"] for r in after}


def test_decontamination(stages, spark):
    from test_decontamination import plain_matches

    before, after, _ = stages[0]["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{stages[1]}/benchmark.parquet").collect()]
    dirty = {m[0] for m in plain_matches([(r["doc_id"], r["text"]) for r in before], items)}
    assert {900_006, 900_007} <= dirty
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - dirty


def test_secret_scan(stages):
    before, after, _ = stages[0]["secret_scan"]
    clean = lambda t: re.sub(r'(?i)(token = ")[0-9a-f]{40}(")', r"\1<secret>\2", t)
    want = {r["doc_id"]: clean(r["text"]) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after) and "<secret>" in want[900_008]


def test_packing(stages):
    from test_packing import check_batches

    before, after, _ = stages[0]["packing"]
    lengths = {r["doc_id"]: len(r["text"].encode().split()) + 1 for r in before}
    total = {}
    for r in after:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == lengths
    check_batches(after, packing.TOKEN_BUDGET, sum(lengths.values()))


def test_run_gives_the_last_stage(stages, spark):
    got = P.run(spark, stages[1])
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["bucket"], r["batch"], r["slot"]) for r in rows)
    assert key(r.asDict() for r in got.collect()) == key(stages[0]["packing"][1])


def test_empty_documents(spark, awkward, tmp_path, sf_dir):
    folder = str(tmp_path)
    awkward.where("false").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).count() == 0


def test_awkward_documents(spark, awkward, tmp_path, sf_dir):
    folder = str(tmp_path)
    awkward.withColumns({"code": F.lit(1), "score": F.lit("x"), "word": F.lit(2)}).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    ids = {r["doc_id"] for r in P.run(spark, folder).collect()}
    assert ids == {4, 5, 6, 8, 9, 10, 11, -5, 2**62, None}
