"""Connected components of a graph of any size, and links found by pivots.

Both work in rounds that end in a written table, so the lineage stays short and a lost
executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokenloom.session import settle


def _toward_smallest(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest node around it.

    Every node with more neighbours hands them all to the smallest one; the number of edges
    does not grow, and a hot node is a skewed join key at worst.
    """
    both = edges if smaller_only else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("low"))
    smallest = smallest.select("a", F.least("a", "low").alias("low"))
    moved = both.join(smallest, "a")
    kept = moved.where(F.col("b") > F.col("a")) if not smaller_only else moved.where(F.col("b") != F.col("low"))
    out = kept.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if smaller_only:
        out = out.union(smallest.select("a", F.col("low").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` (a, b) reaches.

    Alternates two star steps until the edges are stars; ids without an edge are not in the
    result, NULL ends and loops are left out.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = settle(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = settle(_toward_smallest(_toward_smallest(edges, False), True), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
