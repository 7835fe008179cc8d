"""Exact ranked lexical search by a dual tree: items on one side, documents on the other.

A score is the inner product of an item's term weights and a document's term impacts, neither of them negative. Both sides
are put into trees, whose nodes hold for each term the maximum of what is below. The product of an item node's and a
document node's maxima bounds every score between them; if it is below the weakest k-th score that the node's items have so
far, the whole pair of batches is left out. Pairs that remain are opened on both sides, down to the scores themselves.

1. One pass counts terms, documents and document frequencies of the whole table; the frequencies meet the items' terms
   in a join.
2. Items are searched in blocks of a bounded number of terms, each a broadcast. A pass over all documents keeps the impacts of the
   block's terms, in chunks of documents with their maxima, the tops of the document tree.
3. Chunks are searched in two rounds: a sixteenth of them first, then all others, which start from the k-th
   scores found there. Both rounds count, so nothing is sampled; a task returns k documents an item at most.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import pa_type, staged, table

#: Terms of items, repeated for each item, in a block: what is broadcast and what a task holds of the items.
BLOCK_TERMS = 200_000
#: Distinct terms counted before a task hands its counts on.
COUNTED = 400_000
#: Documents below the nodes of the document tree, from the top; a chunk ends early at so many impacts.
DOC_LEVELS = (2048, 256, 32)
CHUNK_IMPACTS = 1 << 20
#: Items below the nodes of the item tree, from the top.
ITEM_LEVELS = (512, 64, 8)
#: One in so many chunks is searched in the first round.
FIRST_ROUND = 16
#: Documents' length normalisation in percent, and what a term frequency is saturated with.
LENGTH_SHARE, SATURATION = 75, 8
BLOCK_CHARS = 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """Maximal runs of digits, letters and characters beyond ASCII, A-Z lower-cased, of a UTF-8 text, in lists of bounded size."""
    folded = (text or b"").translate(_FOLD)
    at = 0
    while at < len(folded):
        to = folded.find(b" ", at + BLOCK_CHARS)
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return pc.cast(batch.column(batch.schema.get_field_index(name)), pa.binary()).to_pylist()


def corpus_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df) of all documents; the row without a term has the documents with any term as df and all terms as total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = total = 0

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(df.keys(), pa.binary()), pa.array(df.values(), pa.int64()), pa.nulls(len(df), pa.int64())],
                names=["term", "df", "total"],
            )

        for batch in batches:
            for text in _texts(batch, "text"):
                found: set[bytes] = set()
                for words in terms(text):
                    found.update(words)
                    total += len(words)
                n += bool(found)
                df.update(found)
                if len(df) > COUNTED:
                    yield counted()
                    df.clear()
        yield counted()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([n]), pa.array([total])], names=["term", "df", "total"])

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "term binary, df bigint, total bigint")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def item_terms(items: DataFrame, ids: str, text: str) -> DataFrame:
    """(item, item_id, term, uses): every distinct term of every item; ``item`` numbers the rows."""
    kind = items.schema[ids].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("item", "item_id")]
            for item, item_id, text in zip(*names, _texts(batch, "text")):
                uses: Counter = Counter()
                for words in terms(text):
                    uses.update(words)
                columns = [pa.array([item] * len(uses), pa.int64()), pa.array([item_id] * len(uses), pa_type(kind))]
                columns += [pa.array(uses.keys(), pa.binary()), pa.array(uses.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "term", "uses"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{ids}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"item bigint, item_id {kind.simpleString()}, term binary, uses bigint")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class ItemTree:
    """Items of a block, like ones side by side, and the maxima of groups of them.

    A level is a list of groups, one after the other: where each group's terms begin, the terms, and the largest weight
    of each term in the group. Groups of a level nest in those of the level before.
    """

    def __init__(self, entries: list[tuple[int, int, int]], levels: tuple[int, ...] = ITEM_LEVELS):
        """``entries``: (item, column, weight) of items 0, 1, ..."""
        e = np.array(sorted(entries), np.int64).reshape(-1, 3)
        n = int(e[:, 0].max()) + 1
        strongest = np.full(n, -1)
        by_weight = np.lexsort((e[:, 1], e[:, 2]))
        strongest[e[by_weight, 0]] = e[by_weight, 1]  # the last one stays
        self.order = np.lexsort((np.arange(n), strongest))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        e[:, 0] = place[e[:, 0]]
        sums = np.bincount(e[:, 0], e[:, 2].astype(float))
        #: Products and their sums are whole numbers: doubles while they hold these exactly, else 64-bit integers.
        self.kind = np.float64 if sums.max() * 1e6 < 1 << 52 else np.int64
        self.n, self.width = n, int(e[:, 1].max()) + 1
        self.strength = np.zeros(self.width, np.int64)
        np.maximum.at(self.strength, e[:, 1], e[:, 2])
        self.levels = []
        for size in levels:
            group = e[:, 0] // size
            cells, at = np.unique(group * self.width + e[:, 1], return_inverse=True)
            most = np.zeros(len(cells), np.int64)
            np.maximum.at(most, at, e[:, 2])
            starts = np.searchsorted(cells, np.arange(-(-n // size)) * self.width)
            self.levels.append((size, starts, cells % self.width, most.astype(self.kind)))
        size, starts, columns, _ = self.levels[-1]
        self.leaves = []
        ends = [*starts[1:], len(columns)]
        firsts = np.searchsorted(e[np.argsort(e[:, 0], kind="stable"), 0], np.arange(0, n + size, size))
        e = e[np.argsort(e[:, 0], kind="stable")]
        for g, (a, b) in enumerate(zip(starts, ends)):
            mine = e[firsts[g] : firsts[g + 1]]
            matrix = np.zeros((b - a, min(size, n - g * size)), self.kind)
            matrix[np.searchsorted(columns[a:b], mine[:, 1]), mine[:, 0] - g * size] = mine[:, 2]
            self.leaves.append((columns[a:b], matrix))

    def bounds(self, level: int, maxima: np.ndarray) -> np.ndarray:
        """Of every group of the level with a document node, given that node's maxima by column."""
        _, starts, columns, most = self.levels[level]
        return np.add.reduceat(maxima[columns] * most, starts)

    def weakest(self, level: int, floors: np.ndarray) -> np.ndarray:
        """The least floor among each group's items."""
        return np.minimum.reduceat(floors, np.arange(0, self.n, self.levels[level][0]))

    def below(self, level: int, live: np.ndarray) -> np.ndarray:
        """Which groups of the level lie in live groups of the level before."""
        size, above = self.levels[level][0], self.levels[level - 1][0]
        return live[np.arange(-(-self.n // size)) * size // above]


class Ranking:
    """The k best documents of each item so far, and the score that a document needs to be among them."""

    def __init__(self, items: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.best: list[list[tuple]] = [[] for _ in range(items)]

    def offer(self, item: int, score: int, doc_id: object, row: int) -> None:
        best = self.best[item]
        insort(best, (-score, doc_id is None, 0 if doc_id is None else doc_id, row))
        del best[self.k :]
        if len(best) == self.k:
            self.floors[item] = max(self.floors[item], -best[-1][0])


def search_chunk(tree: ItemTree, ranking: Ranking, ids: list, rows: np.ndarray, starts: np.ndarray, columns: np.ndarray, impacts: np.ndarray, doc_levels: tuple[int, ...] = DOC_LEVELS) -> int:
    """Offer the ranking every document that may be among an item's best. Returns the number of scores worked out.

    Document number i has the columns and impacts from ``starts[i]`` on. Like documents are put side by side first.
    """
    n = len(ids)
    counts = np.diff(starts)
    strength = impacts * tree.strength[columns]
    by = np.lexsort((strength, np.repeat(np.arange(n), counts)))
    order = np.argsort(columns[by[starts[1:] - 1]], kind="stable")
    floors = ranking.floors
    scored = 0
    maxima = np.zeros(tree.width, tree.kind)

    def entries(docs: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(starts[d], starts[d + 1]) for d in docs])

    def visit(level: int, at: int, to: int, live: np.ndarray | None) -> None:
        nonlocal scored
        docs = order[at:to]
        here = entries(docs)
        np.maximum.at(maxima, columns[here], impacts[here].astype(tree.kind))
        bounds = tree.bounds(level, maxima)
        maxima[columns[here]] = 0
        keep = bounds >= tree.weakest(level, floors)
        if live is not None:
            keep &= tree.below(level, live)
        if not keep.any():
            return
        if level + 1 < len(doc_levels):
            for a in range(at, to, doc_levels[level + 1]):
                visit(level + 1, a, min(to, a + doc_levels[level + 1]), keep)
            return
        used, place = np.unique(columns[here], return_inverse=True)
        dense = np.zeros((len(docs), len(used) + 1), tree.kind)  # the last column: terms that no document here has
        dense[np.repeat(np.arange(len(docs)), counts[docs]), place] = impacts[here]
        where = np.full(tree.width, len(used))
        where[used] = np.arange(len(used))
        size = tree.levels[level][0]
        for g in np.flatnonzero(keep):
            group, matrix = tree.leaves[g]
            scores = dense[:, where[group]] @ matrix
            scored += scores.size
            first = g * size
            for d, i in zip(*np.nonzero(scores >= floors[first : first + matrix.shape[1]])):
                if scores[d, i] >= floors[first + i]:  # it may have risen
                    ranking.offer(first + i, int(scores[d, i]), ids[docs[d]], int(rows[docs[d]]))

    for a in range(0, n, doc_levels[0]):
        visit(0, a, min(n, a + doc_levels[0]), None)
    return scored


def impacts_of(tf: np.ndarray, n: int, documents: int, total: int) -> np.ndarray:
    """Impacts of term frequencies in a document of ``n`` terms, in whole numbers."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + SATURATION * m)


def chunks_of(docs: DataFrame, columns: dict[bytes, int], documents: int, total: int, ids: str, text: str, chunk_docs: int = DOC_LEVELS[0]) -> DataFrame:
    """Impacts of the block's terms in all documents that have any: chunk, ids, rows, starts, columns, impacts."""
    spark, kind = docs.sparkSession, docs.schema[ids].dataType
    shared = spark.sparkContext.broadcast(columns)  # the terms of one block
    schema = f"chunk bigint, ids array<{kind.simpleString()}>, rows array<bigint>, starts binary, columns binary, impacts binary"
    kinds = [pa.int64(), pa.list_(pa_type(kind)), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    names = ["chunk", "ids", "rows", "starts", "columns", "impacts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        chunk = TaskContext.get().partitionId() << 32
        row = chunk - 1
        held: list[tuple] = []
        size = 0

        def packed() -> pa.RecordBatch:
            starts = np.cumsum([0, *(len(c) for _, _, c, _ in held)]).astype("<i4")
            values = (chunk, [h[0] for h in held], [h[1] for h in held], starts.tobytes())
            values += tuple(np.concatenate([h[j] for h in held]).astype("<i4").tobytes() for j in (2, 3))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(batch.schema.get_field_index("id")).to_pylist(), _texts(batch, "text")):
                row += 1
                n, found = 0, []
                for words in terms(text):
                    n += len(words)
                    found.append(np.array([c for c in map(get, words) if c is not None], np.int64))
                found = np.concatenate(found) if found else np.zeros(0, np.int64)
                if not len(found):
                    continue
                used, tf = np.unique(found, return_counts=True)
                held.append((doc_id, row, used, impacts_of(tf, n, documents, total)))
                size += len(used)
                if len(held) >= chunk_docs or size >= CHUNK_IMPACTS:
                    yield packed()
                    held, size, chunk = [], 0, chunk + 1
        if held:
            yield packed()

    return docs.select(F.col(f"`{ids}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def _search(chunks: DataFrame, entries: list[tuple[int, int, int]], floors: np.ndarray, k: int, kind: str, levels: tuple, out: pa.DataType) -> DataFrame:
    """(place, doc_id, row, score): of each task, the k best documents of the items (their place in the block)."""
    shared = chunks.sparkSession.sparkContext.broadcast((entries, floors))  # of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, floors = shared.value
        tree = ItemTree(entries, levels[1])
        ranking = Ranking(tree.n, k, floors[tree.order])
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("ids", "rows", "starts", "columns", "impacts")]
            for i in range(batch.num_rows):
                ids, rows, *numbers = (c[i].as_py() for c in columns)
                starts, used, impacts = (np.frombuffer(b, "<i4").astype(np.int64) for b in numbers)
                search_chunk(tree, ranking, ids, np.array(rows), starts, used, impacts, levels[0])
        found = [(int(tree.order[i]), None if b[1] else b[2], b[3], -b[0]) for i, best in enumerate(ranking.best) for b in best]
        if found:
            kinds = [pa.int32(), out, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=["place", "doc_id", "row", "score"])

    return chunks.mapInArrow(run, f"place int, doc_id {kind}, row bigint, score bigint")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    ids: str = "doc_id",
    text: str = "text",
    item_ids: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
    doc_levels: tuple[int, int, int] = DOC_LEVELS,
    item_levels: tuple[int, int, int] = ITEM_LEVELS,
) -> DataFrame:
    """Each item's k highest-scoring documents with a score above 0: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. A null text has none. Equal scores go by
    ascending doc_id, a null one last, then by row; ranks of an item are 1, 2, ... without gaps. Rows that share an id are
    documents (or items) of their own. Items without a term that scores, and empty tables, give no rows. Texts of any
    length are read whole, in pieces. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[ids].dataType, items.schema[item_ids].dataType.simpleString()
    counts = staged(corpus_terms(docs, text), "lexical-terms")
    documents, total = counts.where("term is null").agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    asked = staged(item_terms(items, item_ids, item_text), "lexical-items")
    weighed = asked.select("term").distinct().join(counts.where("term is not null").select("term", "df"), "term")
    asked = asked.join(weighed, "term")
    size = asked.count() if documents else 0
    blocks = -(-size // block_terms)
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(1, blocks))).cast("int")), "lexical-blocks")

    results = []
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).orderBy("item", "term").collect()  # one block, of a bounded number of terms
        rows = [(r["item"], r["item_id"], r["term"], r["uses"] * weight(documents, r["df"])) for r in rows]
        rows = [r for r in rows if r[3] > 0]
        if not rows:
            continue
        numbers = {item: i for i, item in enumerate(dict.fromkeys(r[0] for r in rows))}
        columns = {term: i for i, term in enumerate(dict.fromkeys(r[2] for r in rows))}
        entries = [(numbers[item], columns[term], w) for item, _, term, w in rows]
        names = {numbers[item]: (item, item_id) for item, item_id, _, _ in rows}
        chunks = staged(chunks_of(docs, columns, documents, total, ids, text, doc_levels[0]), "lexical-chunks")
        first = F.pmod(F.xxhash64("chunk"), F.lit(FIRST_ROUND)) == 0
        search = (k, kind.simpleString(), (doc_levels, item_levels), pa_type(kind))
        floors = np.ones(len(numbers), np.int64)
        early = staged(_search(chunks.where(first), entries, floors, *search), "lexical-early")
        weakest = Window.partitionBy("place").orderBy(F.desc("score"), "row")
        reached = early.withColumn("n", F.row_number().over(weakest)).where(F.col("n") == k)
        for r in reached.select("place", "score").collect():  # at most one for each item of the block
            floors[r["place"]] = r["score"]
        found = early.unionByName(_search(chunks.where(~first), entries, floors, *search))
        places = spark.createDataFrame([(i, *names[i]) for i in names], f"place int, item bigint, item_id {item_kind}")
        results.append(found.join(places, "place"))
    if not results:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind.simpleString()}, score bigint")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL
),
stats AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT row_number() OVER () AS ir, item_id, {_TERMS} AS ts FROM benchmark WHERE text IS NOT NULL),
uses AS (SELECT ir, item_id, term, count(*) AS uses FROM (SELECT ir, item_id, unnest(ts) AS term FROM i) GROUP BY ALL),
w AS (
  SELECT ir, item_id, uses.term, uses * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df.df + 1))) AS BIGINT) AS w
  FROM uses JOIN df ON uses.term = df.term CROSS JOIN stats
),
impact AS (
  SELECT tf.r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * len(ts) * n_docs) // total))) AS c
  FROM tf JOIN d ON tf.r = d.r CROSS JOIN stats
),
s AS (
  SELECT ir, item_id, r, doc_id, CAST(sum(w * c) AS BIGINT) AS score
  FROM w JOIN impact ON w.term = impact.term GROUP BY ALL HAVING sum(w * c) > 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ir ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS rank FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
