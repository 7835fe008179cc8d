import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallybridge.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_root(text):
    sections, current = [], ""
    for h in map(sha, (text or "").split("\n")):
        current += h + ("" if h < "2" else " ")
        if h < "2":
            sections.append(current)
            current = ""
    return sha("".join(map(sha, [*sections, current])))


def test_root_is_the_tree_over_lines(spark, awkward):
    rows = awkward.select("text", M.root_hash(F.col("text")).alias("root")).collect()
    assert all(r["root"] == plain_root(r["text"]) for r in rows)
    many = spark.createDataFrame([("\n".join(f"line {i * i}" for i in range(n)),) for n in range(60)], "text string")
    assert all(r["root"] == plain_root(r["text"]) for r in M.fingerprints(many).withColumnRenamed("fingerprint", "root").collect())


def test_differing_branches_locate_edits(spark):
    lines = [f"paragraph number {i}" for i in range(80)]
    edited = [*lines[:11], "changed", *lines[12:40], "new", *lines[40:]]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(edited)), ("same", "same"), (None, "a\nb")], "a string, b string")
    got = [r[0] for r in df.select(M.edited_paragraphs(F.col("a"), F.col("b"))).collect()]
    assert got == [[11, 40], [], [0, 1]]


def plain_next(rows):
    """Rows ordered by id, descending, nulls last; rows of one id by any fixed order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(d, t or "", order[(i + 1) % len(order)][1] or "") for i, (d, t) in enumerate(order)]


@pytest.mark.parametrize("slab", [1, 3, 10_000])
@pytest.mark.parametrize("ids", [range(40), [0, 1, 2, 3, 4, 5, 6, 10**12, 10**12 + 1, 10**15, -(10**9)], [5], [2**62, -(2**62), 0]])
def test_next_document(spark, documents, slab, ids):
    rows = [(i, f"text of {i}") for i in ids]
    random.Random(1).shuffle(rows)
    got = M.with_next(documents(rows), slab).select("doc_id", "text", "next_text").collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_next(rows))


def test_awkward_rows(spark, awkward):
    docs = awkward.withColumns({"cell": F.lit(1), "part": F.lit("p"), "root": F.lit(1), "hash": F.lit(2)})
    got = M.with_next(docs, 2).collect()
    assert len(got) == 16
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2**62]["next_text"].startswith("xxxx") and by_id[1]["next_text"] == "a negative id"
    assert {r["next_text"] for r in got if r["doc_id"] is None} == {"", "a large id"} or {r["next_text"] for r in got if r["doc_id"] is None} == {"no id here", "a large id"}
    assert M.with_next(docs.where("false")).count() == 0
    equal = [r["root"] for r in got if r["doc_id"] in (6, 7)]
    assert len(set(equal)) == 1


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in M.op9_merkle_fingerprint(spark, sf_dir).collect()}
    rows = plain_next([(d["doc_id"], d["text"]) for d in docs])
    for doc_id, text, after in rows:
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain_root(text), plain_root(edited))
        assert 0 <= r["near_next"] <= 1 and (r["near_edited"] == 1) == (edited == text)
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.95 * len(got)


def test_plan_has_no_python(spark, sf_dir):
    plan = M.op9_merkle_fingerprint(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_edits_are_whole(spark):
    lines = [f"paragraph number {i}" for i in range(80)]
    rng = random.Random(4)
    shuffled = rng.sample(lines, 80)
    cases = [
        (lines, lines, [], []),
        (lines, [*lines[:11], "changed", *lines[12:40], "new", *lines[40:]], [11], [11, 40]),
        (lines, lines[:30] + lines[31:], [30], []),
        (lines, [*lines[:50], lines[49], *lines[50:]], [], [50]),
        (["x"] * 100, ["x"], list(range(1, 100)), []),
        (lines, [lines[79], *lines[:79]], [79], [0]),
        (lines, [*lines[1:], lines[0]], [0], [79]),
        (lines, shuffled, None, None),
        (lines * 2, shuffled + lines[::2] + ["x"] * 9, None, None),
        ([""], ["a", "b"], [0], [0, 1]),
    ]
    df = spark.createDataFrame([(i, "\n".join(a), "\n".join(b)) for i, (a, b, _, _) in enumerate(cases)], "k int, a string, b string")
    got = {r["k"]: r for r in M.edits(df, "a", "b", ["k"]).collect()}
    assert len(got) == len(cases)
    for i, (a, b, deleted, inserted) in enumerate(cases):
        r = got[i]
        if deleted is not None:
            assert (i, r["deleted"], r["inserted"]) == (i, deleted, inserted)
        rest = [[p for n, p in enumerate(t) if n not in gone] for t, gone in ((a, r["deleted"]), (b, r["inserted"]))]
        assert rest[0] == rest[1] and (r["in_place"] == 1) == (a == b)


def test_edits_query(spark, sf_dir):
    out = M.op9_merkle_edits(spark, sf_dir)
    assert out.columns == ["doc_id", "deleted", "inserted", "in_place"] and "Python" not in out._jdf.queryExecution().toString()
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(docs)
    for doc_id, text, after in plain_next(docs):
        half, r = len(text) // 2, got[doc_id]
        a, b = text.split("\n"), (text[: len(text) - half] + after[:half]).split("\n")
        assert [p for n, p in enumerate(a) if n not in r["deleted"]] == [p for n, p in enumerate(b) if n not in r["inserted"]]
