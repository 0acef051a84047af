"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.cluster import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over rows (a, b), a > b: hang neighbours on the smallest node around each node.

    The minimum is a partial aggregate and the join back may be split by adaptive execution, so a node
    with very many neighbours never has them gathered in one task.
    """
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = around.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
    return moved.where(F.col("a") > F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    # two independent hashes over the set of edges; equal ones over distinct rows mean an unchanged set. XOR, as a sum of
    # hashes leaves a long from some hundred thousand edges on
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the links (a, b); root is the smallest node of its component.

    Loops until the links stop changing, whatever the length of the longest chain. Every round is
    checkpointed to the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut_lineage(links.where(F.col("a") > F.col("b")).distinct())
    seen = _state(links)
    while seen[0]:
        links = cut_lineage(_star(_star(links, large=True), large=False))
        now = _state(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
