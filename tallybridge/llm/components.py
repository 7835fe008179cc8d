"""Connected components of a link table, as Spark jobs that cut their lineage in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def stars(links: DataFrame) -> DataFrame:
    """The component of every linked node: rows (node, root) with the smallest node of a component as its
    root; the root itself has no row.

    ``links`` has two bigint columns a and b. Large-star and small-star rounds alternate until nothing
    moves (a logarithmic number of rounds). Each round needs only the minimum over a node's neighbours, so a
    node with very many links is pre-aggregated and never gathered in one place.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = staged(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
