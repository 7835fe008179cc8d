"""Exact top-k by inner product over norm-sorted vectors, with partial sums in a rotated basis.

Components are scaled and floored, so scores are integers and ties are real. The table is sorted by descending length and
packed into slabs of consecutive vectors. Queries meet the slabs in rounds, the longest vectors first, each round eight
times as many slabs as all before; after a round every query knows a score that its k best reach already, and three
bounds leave out what cannot reach it:

* a slab whose longest vector is too short for any query of a block is not joined to that block (Cauchy-Schwarz),
* inside a slab, vectors from a length on are not looked at,
* the others are rotated by the right singular vectors of the whole table, which gathers length in the first coordinates:
  the partial sum of these plus the product of the residual lengths bounds the score.

What remains is scored in whole numbers. A bound equal to the weakest score is kept, so that ties go by id. The rotation
comes from second moments summed over all rows; it decides the work, never the result.

Blocks of queries and slabs have a bounded number of bytes and meet in a join on the slab's number; equal vectors, however
many, are spread over slabs by their row number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import pa_type, staged, table

#: Bytes of components (4 each) in a slab, and in a block of queries.
SLAB_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20
#: Each round takes the slabs up to so many times those of all rounds before.
GROWTH = 8
#: Queries scored at once against a slab.
TILE = 512
#: Vectors of more components are searched without a rotation: their moments would be too large a table.
ROTATED_WIDTH = 1024
#: Bounds are floating-point numbers; they get this share of the lengths' product as slack.
SLACK = 1e-9
#: A longer vector (scaled) is refused: products of two such need not fit 64 bits.
LONGEST = float(1 << 31)


def _components(data: bytes, n: int, width: int, padded: int) -> np.ndarray:
    """``n`` vectors of ``width`` components as doubles, filled up with zeros."""
    out = np.zeros((n, padded))
    out[:, :width] = np.frombuffer(data, "<i4").reshape(n, width)
    return out


def slabs_of(vectors: DataFrame, ids: str, vector: str, asked: Column, scale: int, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """The usable vectors by descending length, packed: slab (0 holds the longest), longest, n, width, ids, rids, asked, data.

    ``rid`` numbers the rows, so that rows of one id stay apart. Data are 4-byte integers, row by row.
    """
    kind = vectors.schema[ids].dataType
    usable = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col(f"`{ids}`").alias("id"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
        F.transform(f"`{vector}`", lambda x: x.cast("double")).alias("v"),
    ).where(usable)
    rows = rows.select(
        "id",
        F.monotonically_increasing_id().alias("rid"),
        "asked",
        F.transform("v", lambda x: F.floor(x * scale)).alias("v"),
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("length", length)
    rows = rows.repartitionByRange(F.desc("length"), "rid").sortWithinPartitions(F.desc("length"), "rid")
    rows = rows.withColumn("part", F.spark_partition_id())
    schema = f"part int, seq bigint, longest double, n int, width int, ids array<{kind.simpleString()}>, rids array<bigint>, asked array<boolean>, data binary"
    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa_type(kind)), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]
    names = ["part", "seq", "longest", "n", "width", "ids", "rids", "asked", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, seq = 0, 0

        def packed() -> pa.RecordBatch:
            rows = pa.concat_tables(held).combine_chunks()
            lengths = rows["v"].combine_chunks().value_lengths().to_numpy()
            width = max(1, int(lengths.max()))
            data = np.zeros((len(lengths), width), "<i4")
            longest = rows["length"][0].as_py()
            if longest >= LONGEST:
                raise ValueError(f"a vector of length {longest} (scaled) has scores beyond 64 bits")
            flat = rows["v"].combine_chunks().flatten().to_numpy()
            data[np.arange(width) < lengths[:, None]] = flat
            values = (rows["part"][0].as_py(), seq, longest, len(lengths), width, rows["id"].to_pylist())
            values += (rows["rid"].to_pylist(), rows["asked"].to_pylist(), data.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            whole = pa.Table.from_batches([batch])
            ends = np.cumsum(whole["v"].combine_chunks().value_lengths().to_numpy() * 4 + 32)
            at = 0
            while at < len(ends):
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + slab_bytes - size, "right")))
                held.append(whole.slice(at, to - at))
                size += int(ends[to - 1] - before)
                at = to
                if size >= slab_bytes or at < len(ends):
                    yield packed()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield packed()

    made = staged(rows.mapInArrow(run, schema), "vector-slabs")
    parts = made.groupBy("part").agg(F.count("*").alias("slabs"))  # a row for each task that packed
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("slabs").over(before), F.lit(0)).alias("before"))
    return made.join(F.broadcast(parts), "part").withColumn("slab", F.col("before") + F.col("seq")).drop("part", "seq", "before")


def rotation(slabs: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, the strongest first, from second moments summed over every row."""
    if width > ROTATED_WIDTH:
        return np.eye(width)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for n, w, data in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n", "width", "data"))):
                x = _components(data, n, w, width)
                total += x.T @ x
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total.ravel()[cells])], names=["cell", "value"])

    found = slabs.select("n", "width", "data").mapInArrow(moments, "cell bigint, value double")
    total = np.zeros(width * width)
    for r in found.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # width x width numbers
        total[r["cell"]] = r["value"]
    total = total.reshape(width, width)
    if not np.isfinite(total).all():
        return np.eye(width)
    _, basis = np.linalg.eigh((total + total.T) / 2)
    return np.ascontiguousarray(basis[:, ::-1])


def _queries(slabs: DataFrame) -> DataFrame:
    """The vectors that are asked for: rid, query_id, length, width, data; out of the slabs, in place."""
    kind = slabs.schema["ids"].dataType.elementType
    schema = f"rid bigint, query_id {kind.simpleString()}, length double, width int, data binary"
    kinds = [pa.int64(), pa_type(kind), pa.float64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("ids", "rids", "asked", "width", "data")
        for batch in batches:
            for ids, rids, asked, width, data in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                x = np.frombuffer(data, "<i4").reshape(-1, width)
                at = np.flatnonzero(asked)
                if len(at):
                    lengths = np.sqrt((x[at].astype(float) ** 2).sum(1))
                    out = [[rids[i] for i in at], [ids[i] for i in at], lengths, [width] * len(at), [x[i].tobytes() for i in at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["rid", "query_id", "length", "width", "data"])

    return slabs.select("ids", "rids", "asked", "width", "data").mapInArrow(run, schema)


def _blocks(queries: DataFrame, best: DataFrame | None, width: int, k: int, number: int) -> DataFrame:
    """Queries packed into about ``number`` blocks of like reach: block, reach, rids, query_ids, floors, data.

    A query's floor is the weakest of its k scores so far; a slab whose longest vector is shorter than floor / length (the
    reach; the least of a block counts) cannot improve it.
    """
    rows = queries.withColumn("floor", F.lit(None).cast("bigint"))
    if best is not None:
        floors = best.groupBy("rid").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        rows = queries.join(floors, "rid", "left")
    reach = F.when(F.coalesce(F.col("floor") <= 0, F.lit(True)), 0.0)
    reach = reach.when(F.col("length") == 0, float("inf")).otherwise(F.col("floor") / F.col("length") * (1 - SLACK))
    rows = rows.withColumn("reach", reach).repartitionByRange(number, "reach", "rid").sortWithinPartitions("reach", "rid")
    kind = queries.schema["query_id"].dataType
    most = max(1, BLOCK_BYTES // (4 * width))
    schema = f"reach double, rids array<bigint>, query_ids array<{kind.simpleString()}>, floors array<bigint>, data binary"
    kinds = [pa.float64(), pa.list_(pa.int64()), pa.list_(pa_type(kind)), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            data = np.zeros((len(held), width), "<i4")
            for i, r in enumerate(held):
                data[i, : r[4]] = np.frombuffer(r[5], "<i4")
            values = (held[0][3], [r[0] for r in held], [r[1] for r in held], [r[2] for r in held], data.tobytes())
            names = ["reach", "rids", "query_ids", "floors", "data"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            names = ("rid", "query_id", "floor", "reach", "width", "data")
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                held.append(row)
                if len(held) >= most:
                    yield packed()
                    held = []
        if held:
            yield packed()

    return rows.mapInArrow(run, schema)


class _Slab:
    """A slab's vectors, their lengths and rotated coordinates, and the order of their ids."""

    def __init__(self, ids: list, rids: list[int], n: int, width: int, data: bytes, basis: np.ndarray):
        self.ids, self.rids = ids, np.array(rids, np.int64)
        self.whole = _components(data, n, width, len(basis))
        self.rotated = self.whole @ basis
        self.squares = np.cumsum(self.rotated**2, 1)
        self.length = np.sqrt((self.whole**2).sum(1))
        order = sorted(range(n), key=lambda i: (ids[i] is None, ids[i], rids[i]) if ids[i] is not None else (True, 0, rids[i]))
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)
        self.by_rid = np.argsort(self.rids)

    def residual(self, h: int) -> np.ndarray:
        return np.sqrt(np.maximum(self.squares[:, -1] - (self.squares[:, h - 1] if h else 0.0), 0.0))


def _exact(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Products of all rows; in doubles where every sum is a whole number below 2^53."""
    return q @ v.T if exact else (q.astype(np.int64) @ v.astype(np.int64).T)


def search_tile(q: np.ndarray, rotated: np.ndarray, rids: np.ndarray, floors: np.ndarray, slab: _Slab, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's k best in the slab that reach its floor (NaN: none yet), ties by id."""
    length = np.sqrt((q**2).sum(1))
    floors = np.where(np.isnan(floors), -np.inf, floors)
    slack = SLACK * length[:, None] * slab.length[None, :]
    width = q.shape[1]
    # lengths alone: vectors descend, so what can reach a floor is a head of the slab
    able = length[:, None] * slab.length[None, :] + slack >= floors[:, None]
    cols = np.flatnonzero(able.any(0))
    rows = np.flatnonzero(able.any(1))
    partial = np.zeros((len(rows), len(cols)))
    live = able[np.ix_(rows, cols)]
    done = 0
    for h in sorted({max(1, width // 8), max(1, width // 4), max(1, width // 2)}):
        if not len(rows) or not len(cols) or np.isneginf(floors[rows]).any():
            break
        partial += rotated[np.ix_(rows, range(done, h))] @ slab.rotated[np.ix_(cols, range(done, h))].T
        done = h
        rest = np.sqrt(np.maximum((q[rows] ** 2).sum(1) - (rotated[rows, :h] ** 2).sum(1), 0.0))
        bound = partial + rest[:, None] * slab.residual(h)[cols][None, :] + slack[np.ix_(rows, cols)]
        live &= bound >= floors[rows][:, None]
        r, c = live.any(1), live.any(0)
        rows, cols, live, partial = rows[r], cols[c], live[np.ix_(r, c)], partial[np.ix_(r, c)]
    if not len(rows) or not len(cols):
        return (np.zeros(0, np.int64),) * 3
    exact = bool(length.max() * slab.length.max() < 1 << 52)
    own = slab.by_rid[np.minimum(np.searchsorted(slab.rids, rids[rows], sorter=slab.by_rid), len(slab.rids) - 1)]
    where = np.full(len(slab.rids), -1)
    where[cols] = np.arange(len(cols))
    mine = np.flatnonzero((slab.rids[own] == rids[rows]) & (where[own] >= 0))
    live[mine, where[own[mine]]] = False
    if live.mean() > 0.02:
        products = _exact(q[rows], slab.whole[cols], exact)
        at, to = np.nonzero(live & (products >= floors[rows][:, None]))
        score = products[at, to]
    else:
        at, to = np.nonzero(live)
        score = np.concatenate(
            [(q[rows[at[i : i + 65536]]].astype(np.int64) * slab.whole[cols[to[i : i + 65536]]].astype(np.int64)).sum(1) for i in range(0, len(at), 65536)]
            or [np.zeros(0, np.int64)]
        )
        good = score >= floors[rows][at]
        at, to, score = at[good], to[good], score[good]
    score = score.astype(np.int64)
    order = np.lexsort((slab.place[cols[to]], -score, at))
    at, to, score = at[order], to[order], score[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    best = rank < k
    return rows[at[best]], cols[to[best]], score[best]


def top_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 5,
    ids: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    slab_bytes: int = SLAB_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each row for which ``asked`` holds its k highest inner products with all other rows: query_id, rank, vec_id, score.

    A component x counts as floor(scale * x), x as a double. Vectors that are null or hold a null or non-finite component
    take no part; a shorter vector counts as ending in zeros, an empty one as zero. Equal scores go by ascending id, a
    null id last, then by row. Each row of a repeated id is a row of its own, as a query too; so is one with a null id if
    asked for. Fewer candidates than k give them all; an empty table gives none. A vector whose scaled length is 2^31 or
    more raises, as its scores need not fit 64 bits. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    slabs = slabs_of(vectors, ids, vector, asked, scale, slab_bytes)
    id_kind = vectors.schema[ids].dataType
    total, width, asking = slabs.agg(F.count("*"), F.max("width"), F.sum(F.expr("size(filter(asked, a -> a))"))).first()
    found_schema = f"rid bigint, query_id {id_kind.simpleString()}, vec_id {id_kind.simpleString()}, vec_rid bigint, score bigint"
    if not asking:
        return spark.createDataFrame([], f"query_id {id_kind.simpleString()}, rank int, vec_id {id_kind.simpleString()}, score bigint")
    queries = staged(_queries(slabs), "vector-queries")
    number = max(1, math.ceil(asking * width * 4 / block_bytes))
    shared = spark.sparkContext.broadcast(rotation(slabs, width))  # width x width numbers
    kinds = [pa.int64(), pa_type(id_kind), pa_type(id_kind), pa.int64(), pa.int64()]
    names = ["rid", "query_id", "vec_id", "vec_rid", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = shared.value
        columns = ("rids", "query_ids", "floors", "data", "ids", "vec_rids", "n", "width", "vec_data")
        for batch in batches:
            for i in range(batch.num_rows):
                rids, query_ids, floors, data, vec_ids, vec_rids, n, w, vec_data = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in columns)
                slab = _Slab(vec_ids, vec_rids, n, w, vec_data, basis)
                block = _components(data, len(rids), len(basis), len(basis))
                numbers, least = np.array(rids, np.int64), np.array([math.nan if f is None else float(f) for f in floors])
                for at in range(0, len(rids), TILE):
                    q = block[at : at + TILE]
                    r, c, score = search_tile(q, q @ basis, numbers[at : at + TILE], least[at : at + TILE], slab, k)
                    out = [numbers[at + r], [query_ids[at + j] for j in r], [vec_ids[j] for j in c], slab.rids[c], score]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=names)

    best = None
    ranked = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_rid")
    begin, end = 0, 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    while begin < total:
        width_of_round = min(end, total) - begin
        here = slabs.where(F.col("slab").between(begin, end - 1))
        here = here.select("slab", "longest", "ids", F.col("rids").alias("vec_rids"), "n", "width", F.col("data").alias("vec_data"))
        blocks = _blocks(queries, best, width, k, number).withColumn("slab", F.explode(F.sequence(F.lit(begin), F.lit(min(end, total) - 1))))
        n = min(width_of_round, tasks)
        pairs = blocks.repartition(n, "slab").join(here.repartition(n, "slab").hint("merge"), "slab")
        pairs = pairs.where(F.col("longest") * (1 + SLACK) >= F.col("reach"))
        found = pairs.drop("slab", "reach", "longest").mapInArrow(run, found_schema)
        if best is not None:
            found = found.unionByName(best)
        best = staged(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).drop("rank"), "vector-best")
        begin, end = end, end * GROWTH
    return best.select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score")


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every vector whose id is divisible by 50, with all other vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
p AS (
  SELECT a.r AS qr, a.vec_id AS query_id, b.r AS vr, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: coalesce(z[1] * z[2], 0))) AS BIGINT) AS score
  FROM q a JOIN v b ON a.r <> b.r
),
s AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id ASC NULLS LAST, vr) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM s WHERE rank <= 5
"""
