import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybridge.llm import inner_products as I

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, k=5, scale=256):
    """Brute force over all pairs of rows."""
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for a, (i, v) in enumerate(whole):
        if i is None or i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0) for b, (j, w) in enumerate(whole) if b != a]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def crowd(seed, n=240, width=12):
    """Lengths from tiny to large, a hot vector in a third of the rows, small whole numbers that tie."""
    rng = random.Random(seed)
    hot = [rng.gauss(0, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = hot
        elif i % 3 == 1:
            v = [rng.randint(-2, 2) / 256 for _ in range(width)]
        else:
            v = [rng.gauss(0, 1) * 10 ** rng.uniform(-2, 2) for _ in range(width)]
        rows.append((i * 5 if i % 7 else 50 * (i % 4), v))
    return rows


@pytest.mark.parametrize("seed,slab,block", [(1, 900, 100), (2, 2000, 10_000), (3, 1 << 20, 1 << 22)])
def test_against_all_pairs(spark, seed, slab, block):
    rows = crowd(seed)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert found(I.top_products(df, F.col("vec_id") % 50 == 0, slab_bytes=slab, block_bytes=block)) == plain(rows)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (50, None),
        (100, [1.0, None]),
        (150, [float("nan"), 1.0]),
        (200, [float("inf")]),
        (250, []),
        (300, [0.5]),
        (350, [-1.0, 0.25, 1e5]),
        (None, [1.0, 2.0]),
        (None, None),
        (-50, [0.001, -0.001]),
        (7, [3.0] * 40),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"rank": F.lit("x"), "Score": F.lit(1), "query_id": F.lit(2)})
    out = I.top_products(df, F.col("vec_id") % 50 == 0, slab_bytes=400)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(out) == plain(rows)
    everything = I.top_products(df, F.col("vec_id") % 50 == 0, k=100)
    assert found(everything) == plain(rows, 100)


def test_few_rows_and_empty_tables(spark):
    one = spark.createDataFrame([(50, [1.0])], VECTORS)
    for df in (one, one.where("false"), one.withColumn("embedding", F.lit(None).cast("array<double>")), one.withColumn("vec_id", F.lit(3))):
        out = I.top_products(df, F.col("vec_id") % 50 == 0)
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_text_ids_and_floats(spark):
    rows = [(f"v{i:03}", [random.Random(i).uniform(-1, 1) for _ in range(8)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    got = found(I.top_products(df, F.col("vec_id").endswith("0"), k=3, slab_bytes=700))
    as_long = df.withColumn("vec_id", F.substring("vec_id", 2, 9).cast("long"))
    want = found(I.top_products(as_long, F.col("vec_id") % 10 == 0, k=3))
    assert got == [(f"v{a:03}", r, f"v{b:03}", s) for a, r, b, s in want]


def test_large_components(spark):
    rows = [(50 * i, [(-1.0) ** i * 3e6, 1.0 + i]) for i in range(9)]  # products beyond 2^53
    assert found(I.top_products(spark.createDataFrame(rows, VECTORS), F.lit(True))) == plain(rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        I.top_products(spark.createDataFrame([(1, [1e12])], VECTORS), F.lit(True))


def test_bounds_leave_work_out(spark):
    """Long vectors first: with a floor known, short slabs give nothing and cost nothing."""
    rng = random.Random(5)
    basis = I.np.eye(8)
    short = I._Slab(list(range(50)), list(range(50)), 50, 8, I.np.ones((50, 8), "<i4").tobytes(), basis)
    q = I.np.array([[rng.randint(50, 90) for _ in range(8)]], float)
    r, c, s = I.search_tile(q, q, I.np.array([99]), I.np.array([1e6]), short, 5)
    assert len(r) == len(c) == len(s) == 0
    r, c, s = I.search_tile(q, q, I.np.array([99]), I.np.array([float("nan")]), short, 5)
    assert c.tolist() == [0, 1, 2, 3, 4] and set(s.tolist()) == {int(q.sum())}


def test_rotation_gathers_length(spark):
    rows = [(i, [float(x) for x in (i % 3, 10 + i % 5, -(10 + i % 5), 0)]) for i in range(40)]
    slabs = I.slabs_of(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", F.lit(True), 1)
    basis = I.rotation(slabs, 4)
    assert abs(basis.T @ basis - I.np.eye(4)).max() < 1e-12
    first = abs(I.np.array([v for _, v in rows]) @ basis).sum(0)
    assert first[0] > 5 * first[1:].sum()
