"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through Burkhard-Keller trees.

A tree's children are keyed by their integer Hamming distance to the parent; a search follows only the
edges within the radius around its own distance. One tree over all fingerprints would neither fit a task
nor be searched fast, and sending all trees to all tasks would broadcast the corpus. So the trees are
sharded: fingerprints within r bits agree in at least one of r + 1 blocks of their bits, and each
fingerprint goes, in one shuffle, to the tree of each of its r + 1 block values. Trees that would exceed
``TREE_ROWS`` are sharded again by the blocks of their remaining bits; every pair within the radius still
meets, so no link is lost at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import map_text, staged, table, word_blocks
from tallybridge.llm.components import stars

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42
#: Shard a tree again if it has more fingerprints. Any value gives the same links.
TREE_ROWS = 2048


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text: a bit is set if it is set in over half the shingles' XXH64 (seed 42, unsigned).

    A-Z are lower-cased; words are runs without ASCII white space; fewer words than a shingle make one
    shingle; null, empty and blank texts have fingerprint 0. Repeated shingles count repeatedly.
    """
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones, n, tail = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks(text or ""):
        words = tail + words
        if len(words) >= shingle:
            hashes = [digest(join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
            for at in range(0, len(hashes), 1 << 14):
                h = np.array(hashes[at : at + (1 << 14)], "<u8")
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(0, dtype=np.uint32)
            n += len(hashes)
        tail = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not n:
        if not tail:
            return 0
        return digest(join(tail), SEED)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, carry: list[str] | None = None, name: str = "code"
) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the fingerprint as a signed 64-bit integer."""

    def make() -> Callable:
        def of(texts: list) -> dict:
            codes = np.array([fingerprint_of(t, shingle) for t in texts], np.uint64)
            return {name: codes.view(np.int64)}

        return of

    return map_text(docs, text, f"{name} bigint", make, carry)


def tree_links(codes: list[int], radius: int) -> list[int]:
    """For each of distinct unsigned codes the position of a code of its component (links within ``radius``).

    Codes are inserted into one tree. Before its insertion a code searches the tree and is united with what it
    finds. A subtree that lies wholly in the component found already is passed over: it can only repeat
    the news. That keeps a crowd of like codes from being searched pair by pair.
    """
    parent = list(range(len(codes)))
    kids: list[dict[int, int]] = [{} for _ in codes]
    mixed = bytearray(len(codes))
    fresh = 64

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x in range(1, len(codes)):
        code, stack, mine = codes[x], [0], x
        while stack:
            at = stack.pop()
            if not mixed[at] and find(at) == mine and mine != x:
                continue
            d = (code ^ codes[at]).bit_count()
            if d <= radius:
                root = find(at)
                if root != mine:
                    low, high = min(root, mine), max(root, mine)
                    parent[high] = low
                    mine = low
                    if not mixed[at]:
                        continue
            children = kids[at]
            if children:
                stack += [k for e, k in children.items() if d - radius <= e <= d + radius]
        at = 0
        while True:
            if not mixed[at] and find(at) != mine:
                mixed[at] = 1
            d = (code ^ codes[at]).bit_count()
            after = kids[at].get(d)
            if after is None:
                kids[at][d] = x
                break
            at = after
        if x + 1 == fresh:  # unions have made subtrees uniform again; children come after their parents
            fresh *= 2
            roots = [find(i) for i in range(x + 1)]
            for i in range(x, -1, -1):
                mixed[i] = any(mixed[k] or roots[k] != roots[i] for k in kids[i].values())
    return [find(i) for i in range(len(codes))]


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    """Split ``width`` bits into ``parts`` blocks: (lowest bit, number of bits)."""
    cuts = [round(i * width / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _shard(rows: DataFrame, width: int, radius: int) -> DataFrame:
    """Rows (shard, code, rest) once for each block of the ``width`` bits left in ``rest``; the block's bits leave ``rest``."""
    options = []
    for low, size in _blocks(width, radius + 1):
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        above = F.shiftleft(F.shiftrightunsigned("rest", low + size), low) if low + size < BITS else F.lit(0)
        rest = above.bitwiseOR(F.col("rest").bitwiseAND(F.lit((1 << low) - 1)))
        options.append(F.struct(F.xxhash64("shard", F.lit(low), value).alias("shard"), rest.cast("long").alias("rest")))
    spread = rows.select("code", F.explode(F.array(*options)).alias("o"))
    return spread.select("o.shard", "code", "o.rest")


def links(codes: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly the codes within ``radius`` bits, directly or through others.

    ``codes`` has the distinct codes. Not every pair is listed: each tree gives every code one link at most.
    """
    rows, width, done = codes.select(F.lit(0).cast("long").alias("shard"), "code", F.col("code").alias("rest")), BITS, []
    if codes.count() > tree_rows:
        while True:
            size = width - max(s for _, s in _blocks(width, radius + 1))
            rows = _shard(rows, width, radius)
            width = min(size, width)
            if width < 2 * (radius + 1):  # at most 2**width codes are left in a shard
                break
            large = staged(rows.groupBy("shard").count().where(F.col("count") > tree_rows).select("shard"), "shards")
            if large.isEmpty():
                break
            done.append(rows.join(large, "shard", "left_anti"))
            rows = rows.join(large, "shard")
    for more in done:
        rows = rows.unionByName(more)

    def linked(shards: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True])
        sizes = np.diff(cuts)
        pairs = cuts[:-1][sizes == 2]
        pairs = pairs[np.bitwise_count(codes[pairs] ^ codes[pairs + 1]) <= radius]
        a, b = [codes[pairs]], [codes[pairs + 1]]
        for at in np.flatnonzero(sizes > 2):
            shard = codes[cuts[at] : cuts[at + 1]]
            root = np.array(tree_links(shard.tolist(), radius))
            other = np.flatnonzero(root != np.arange(len(root)))
            a.append(shard[other])
            b.append(shard[root[other]])
        arrays = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, codes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            shards = np.concatenate([shards, batch.column("shard").to_numpy()])
            codes = np.concatenate([codes, batch.column("code").to_numpy().view(np.uint64)])
            last = int(np.searchsorted(shards, shards[-1])) if len(shards) else 0
            if last:  # the last shard may go on in the next batch
                yield linked(shards[:last], codes[:last])
                shards, codes = shards[last:], codes[last:]
        if len(shards):
            yield linked(shards, codes)

    return rows.select("shard", "code").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a bigint, b bigint")


def classes(marked: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row for each code of ``marked`` (doc_id, code): code, ``root`` (a code that names its component), its
    smallest doc_id ``first_id``, and ``component_id``, the smallest doc_id of all that links reach.

    Null ids take part; they are the smallest only where a component has no other.
    """
    codes = staged(marked.groupBy("code").agg(F.min("doc_id").alias("first_id")), "codes")
    linked = stars(links(codes, radius, tree_rows))
    rooted = codes.join(linked, codes["code"] == linked["node"], "left")
    rooted = rooted.select("code", "first_id", F.coalesce("root", "code").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("code", "root", "first_id", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts share fingerprint 0 and are linked like any other. An empty table gives an empty result.
    """
    marked = staged(fingerprints(docs, text, shingle, carry=["doc_id"]), "fingerprints")
    found = classes(marked, radius).select("code", "component_id")
    return marked.join(found, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, columns as they are, that stand for their component: the one with the smallest doc_id.

    Several rows with that id: the smallest fingerprint stays, then the smallest hashes of all columns. A
    component of rows without id keeps one row by the same rules. A row is named by its id and two hashes of its
    columns, so that texts move once, in the join with the rows that stay.
    """
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant", "void"))]
    keys = ["__id", "__none", "__first", "__second"]
    named = docs.withColumns(
        {
            "__id": F.coalesce("doc_id", F.lit(0)).cast("long"),
            "__none": F.col("doc_id").isNull(),
            "__first": F.xxhash64(*hashed),
            "__second": F.xxhash64(F.lit(1), *hashed[::-1]),
        }
    )
    marked = staged(fingerprints(named, text, shingle, carry=["doc_id", *keys], name="__code"), "marked")
    found = classes(marked.select("doc_id", F.col("__code").alias("code")), radius)
    of_code = marked.groupBy("__code").agg(F.min(F.struct("__none", "__id", "__first", "__second")).alias("row"))
    rows = found.select("root", "code").join(of_code, F.col("code") == F.col("__code"))
    rank = F.struct("row.__none", "row.__id", "code", "row.__first", "row.__second")
    stays = rows.groupBy("root").agg(F.min_by("row", rank).alias("row")).select("row.*")
    out = named.join(stays, keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))  # equal rows are told apart by nothing
    return out.withColumn("__nth", nth).where("__nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links at 3 bits or fewer."""
    return near_duplicates(table(spark, sf_dir, "documents"))
