"""Document fingerprints: a Merkle tree over paragraphs and sections, in built-in functions only.

Lines are paragraphs, and each is hashed. A section ends with a paragraph whose hash begins with 0 or 1 (one in
eight), so that an insertion moves no border beyond its own section. A section hashes its paragraphs'
hashes, the root its sections' hashes. Equal texts have equal roots; where roots differ, going down the
differing branches finds the edited paragraphs. For the likeness of two trees the paragraphs are looked
at by passages: runs that end with a mark or an ``e`` before a blank, or with the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import staged, table

#: Every character of a text is in exactly one passage.
PASSAGE = r"(?s).*?(?:[.,;:!?|%$&#*e] |\n)|.+"
#: Rows of a neighbourhood within which the next document is looked up. Any value gives the same result.
SLAB_ROWS = 2048
#: Neighbourhood tables are broadcast up to so many rows of a few numbers each, and joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def paragraph_hashes(text: Column) -> Column:
    """SHA-256 of each line, as hex digits."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))


def section_hashes(paragraphs: Column) -> Column:
    """SHA-256 over the paragraph hashes of each section."""
    ends = F.transform(paragraphs, lambda h: F.concat(h, F.when(h < "2", "/").otherwise(" ")))
    return F.transform(F.split(F.array_join(ends, ""), "/", -1), lambda s: F.sha2(s, 256))


def root_hash(text: Column) -> Column:
    """The root of a whole text's tree; a null text counts as empty."""
    return F.sha2(F.array_join(section_hashes(paragraph_hashes(F.coalesce(text, F.lit("")))), ""), 256)


def passages(text: Column) -> Column:
    """Distinct hashes of the passages of a whole text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PASSAGE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def likeness(root_a: Column, passages_a: Column, root_b: Column, passages_b: Column) -> Column:
    """1 if the roots are equal; else the share of the distinct passages of both that both have."""
    shared = F.size(F.array_intersect(passages_a, passages_b))
    both = F.size(passages_a) + F.size(passages_b)
    return F.when(root_a == root_b, 1.0).when(both == 0, 0.0).otherwise(2.0 * shared / both)


def edited_paragraphs(text_a: Column, text_b: Column) -> Column:
    """0-based positions of the paragraphs of ``text_b`` that ``text_a`` has nowhere. Deleted, moved and repeated
    paragraphs are not among them: ``edits`` finds all."""
    a, b = paragraph_hashes(F.coalesce(text_a, F.lit(""))), paragraph_hashes(F.coalesce(text_b, F.lit("")))
    known = F.array_except(section_hashes(b), section_hashes(a))
    places = F.transform(b, lambda h, i: F.when(~F.array_contains(a, h), i))
    return F.when(F.size(known) == 0, F.array().cast("array<int>")).otherwise(F.array_compact(places))


def _in_place(rows: DataFrame, within: list[str], at: str) -> DataFrame:
    """Add ``kept``: whether a node has its equal on the other side, in the same order as the others that are kept.

    Nodes (``h`` at position ``at`` on ``side`` 0 or 1) are matched by hash and by how manieth of its hash it is. Of the matches
    those are kept that pass all before them or, where that keeps more, all after them.
    """
    nth = F.row_number().over(Window.partitionBy(*within, "side", "h").orderBy(at))
    both = Window.partitionBy(*within, "h", "nth")
    rows = rows.withColumn("nth", nth)
    rows = rows.withColumns({f"at{n}": F.max(F.when(F.col("side") == n, F.col(at))).over(both) for n in (0, 1)})
    matched = F.col("at0").isNotNull() & F.col("at1").isNotNull()
    rows = rows.withColumns({"at0": F.when(matched, F.col("at0")), "at1": F.when(matched, F.col("at1"))})
    order = Window.partitionBy(*within, "side").orderBy("at1")
    up = F.max("at0").over(order.rowsBetween(Window.unboundedPreceding, 0)) == F.col("at0")
    down = F.min("at0").over(order.rowsBetween(0, Window.unboundedFollowing)) == F.col("at0")
    rows = rows.withColumns({"up": F.coalesce(up, F.lit(False)), "down": F.coalesce(down, F.lit(False))})
    whole = Window.partitionBy(*within, "side")
    rows = rows.withColumns({f"n_{c}": F.sum(F.col(c).cast("int")).over(whole) for c in ("up", "down")})
    kept = F.when(F.col("n_up") >= F.col("n_down"), F.col("up")).otherwise(F.col("down"))
    return rows.withColumn("kept", kept).drop("nth", "at0", "at1", "up", "down", "n_up", "n_down")


def edits(pairs: DataFrame, a: str, b: str, carry: list[str]) -> DataFrame:
    """One row for each row of ``pairs``: the columns ``carry``, ``deleted`` and ``inserted`` (0-based positions of paragraphs of
    text ``a`` and text ``b``) and ``in_place``, the share of the paragraphs of both that are neither.

    Sections are compared first, and only the paragraphs of sections that differ, between the same kept neighbours. Without
    the paragraphs listed both texts are the same; a moved paragraph is listed on both sides, each copy of a repeated one
    counts, and equal roots have empty lists. The lists need not be the shortest. Null texts count as empty.
    """
    side = lambda n, c: F.struct(
        F.lit(n).alias("side"),
        F.transform(
            F.split(F.array_join(F.transform(paragraph_hashes(F.coalesce(F.col(c), F.lit(""))), lambda h: F.concat(h, F.when(h < "2", "/").otherwise(" "))), ""), "/", -1),
            lambda s: F.struct(F.xxhash64(F.sha2(s, 256)).alias("h"), F.transform(F.regexp_extract_all(s, F.lit("[0-9a-f]{64}"), F.lit(0)), lambda p: F.xxhash64(p)).alias("below")),
        ).alias("sections"),
    )
    rows = pairs.select(F.struct(*carry).alias("carry"), F.col(a), F.col(b), F.monotonically_increasing_id().alias("id"))
    rows = rows.select("carry", "id", F.explode(F.array(side(0, a), side(1, b))).alias("t"))
    rows = rows.select("carry", "id", "t.side", F.posexplode("t.sections").alias("section", "s"))
    rows = staged(rows.select("carry", "id", "side", "section", "s.h", "s.below"), "sections")

    order = Window.partitionBy("id", "side").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    sections = rows.withColumn("size", F.size("below")).withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0)))
    sections = _in_place(sections.drop("carry"), ["id"], "section")
    sections = sections.withColumn("gap", F.coalesce(F.sum(F.col("kept").cast("int")).over(order), F.lit(0)))
    below = sections.where("not kept").select("id", "side", "gap", "start", F.posexplode("below").alias("n", "h"))
    below = _in_place(below.select("id", "side", "gap", (F.col("start") + F.col("n")).cast("int").alias("at"), "h"), ["id", "gap"], "at")
    places = lambda n: F.array_sort(F.collect_list(F.when(F.col("side") == n, F.col("at"))))
    found = below.where("not kept").groupBy("id").agg(places(0).alias("deleted"), places(1).alias("inserted"))
    out = rows.groupBy("id").agg(F.first(F.when((F.col("side") == 0) & (F.col("section") == 0), F.col("carry")), ignorenulls=True).alias("carry"), F.sum(F.size("below")).alias("all"))
    out = out.join(found, "id", "left")
    none = F.array().cast("array<int>")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("deleted", "inserted")})
    return out.select("carry.*", "deleted", "inserted", (1 - (F.size("deleted") + F.size("inserted")) / F.col("all")).alias("in_place"))


def _with_slabs(docs: DataFrame, slab_rows: int) -> DataFrame:
    """Add ``cell`` and ``part``, whose order is that of doc_id and which hold about ``slab_rows`` rows each.

    Cells divide the range of ids evenly; a cell with far more rows is divided again by its own range. Null
    ids have a cell of their own, below all others.
    """
    ids = docs.select("doc_id")
    n, low, high = ids.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return docs.withColumns({"cell": F.lit(-1).cast("long"), "part": F.lit(0).cast("long")})
    width = max(1.0, (float(high) - float(low) + 1.0) * slab_rows / n)
    place = F.floor((F.col("doc_id").cast("double") - float(low)) / width)
    cell = F.coalesce(place, F.lit(-1)).cast("long").alias("cell")
    full = ids.select("doc_id", cell).where("doc_id is not null").groupBy("cell")
    full = full.agg(F.count("*").alias("rows"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    full = full.where((F.col("rows") > 2 * slab_rows) & (F.col("hi") > F.col("lo")))
    docs = docs.withColumn("cell", cell)
    crowded = full.count()
    if not crowded:
        return docs.withColumn("part", F.lit(0).cast("long"))
    full = full.select("cell", "lo", (slab_rows * (F.col("hi") - F.col("lo") + 1.0) / F.col("rows")).alias("step"))
    docs = docs.join(F.broadcast(full) if crowded <= BROADCAST_ROWS else full, "cell", "left")
    part = F.floor((F.col("doc_id") - F.col("lo")) / F.greatest("step", F.lit(1.0)))
    return docs.withColumn("part", F.coalesce(part, F.lit(0)).cast("long")).drop("lo", "step")


def with_next(docs: DataFrame, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Rows (doc_id, text, root, passages, next_text, next_root, next_passages) of (doc_id, text).

    The next document is the one with the next smaller doc_id; after the smallest comes the largest. Rows
    of one id follow each other by the hash of their text; null ids come last. Texts move once: the rows
    of a neighbourhood of ids meet, and with them a copy of the row that comes first in the one below.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = _with_slabs(docs.withColumn("h", F.xxhash64("text")), slab_rows)
    slab = ["cell", "part"]
    heads = docs.groupBy(*slab).agg(F.max(F.struct("doc_id", "h")).alias("head"))
    # one row for each neighbourhood, without texts
    order = Window.orderBy(F.desc("cell"), F.desc("part"))
    heads = heads.withColumn("above", F.lag(F.struct(*slab)).over(order))
    heads = heads.withColumn("last", F.last(F.struct(*slab)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select(
        F.col("cell").alias("head_cell"),
        F.col("part").alias("head_part"),
        F.col("head.doc_id").alias("head_id"),
        F.col("head.h").alias("head_hash"),
        F.coalesce("above", "last").alias("above"),
    )
    n = heads.count()
    is_head = (F.col("cell") == F.col("head_cell")) & (F.col("part") == F.col("head_part"))
    is_head &= F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash"))
    docs = docs.withColumnRenamed("h", "hash")
    guests = docs.join(F.broadcast(heads) if n <= BROADCAST_ROWS else heads, is_head, "left")
    own = F.struct("cell", "part", F.lit(False).alias("guest"))
    copy = F.struct("above.cell", "above.part", F.lit(True).alias("guest"))
    at = F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, copy))
    rows = guests.select("doc_id", "text", "hash", F.explode(at).alias("at")).select("doc_id", "text", "hash", "at.*")
    rows = rows.repartition(*slab)
    rows = rows.withColumns({"root": root_hash(F.col("text")), "passages": passages(F.col("text"))})
    after = Window.partitionBy(*slab).orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("hash"))
    ahead = {f"next_{c}": F.lead(c).over(after) for c in ("text", "root", "passages")}
    return rows.withColumns(ahead).where("not guest").select("doc_id", "text", "root", "passages", *ahead)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``fingerprint``, the root of each text's tree."""
    return docs.withColumn("fingerprint", root_hash(F.col(text)))


def _edited() -> Column:
    """The first half of a text, and as much of the next document's as it lacks."""
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))


def op9_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they and the next document's are."""
    rows = with_next(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.select("doc_id", "n_chars", "root", "passages", "next_root", "next_passages", _edited().alias("edited"))
    rows = rows.withColumns({"edited_root": root_hash(F.col("edited")), "edited_passages": passages(F.col("edited"))})
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("root").alias("fingerprint"),
        F.col("edited_root").alias("edited_fingerprint"),
        likeness(F.col("root"), F.col("passages"), F.col("edited_root"), F.col("edited_passages")).alias("near_edited"),
        likeness(F.col("root"), F.col("passages"), F.col("next_root"), F.col("next_passages")).alias("near_next"),
    )


def op9_merkle_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each text and its edited text differ, found by going down the differing branches of their trees."""
    rows = with_next(table(spark, sf_dir, "documents")).select("doc_id", "text", _edited().alias("edited"))
    return edits(rows, "text", "edited", ["doc_id"])


OP9_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
), nexts AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM docs
), texts AS (
  SELECT *, text[1:n_chars - n_chars // 2] || next_text[1:n_chars // 2] AS edited FROM nexts
), parts AS (
  SELECT doc_id, n_chars, edited,
    list_transform([text, edited, next_text], lambda x: list_distinct(regexp_extract_all(x, '(?s).*?(?:[.,;:!?|%$&#*e] |\n)|.+'))) AS p,
    list_transform([text, edited, next_text], lambda x: sha256(array_to_string(list_transform(string_split(array_to_string(
      list_transform(list_transform(string_split(x, chr(10)), lambda l: sha256(l)),
        lambda h: h || CASE WHEN h < '2' THEN '/' ELSE ' ' END), ''), '/'), lambda s: sha256(s)), ''))) AS r
  FROM texts
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, r[1] AS fingerprint, r[2] AS edited_fingerprint,
  CASE WHEN r[1] = r[2] THEN 1.0 WHEN len(p[1]) + len(p[2]) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * len(list_intersect(p[1], p[2])) / (len(p[1]) + len(p[2])) END::DOUBLE AS near_edited,
  CASE WHEN r[1] = r[3] THEN 1.0 WHEN len(p[1]) + len(p[3]) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * len(list_intersect(p[1], p[3])) / (len(p[1]) + len(p[3])) END::DOUBLE AS near_next
FROM parts
"""
