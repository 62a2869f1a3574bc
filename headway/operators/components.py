"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import release, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id per node, as ``(id, component)``.

    Alternating star operations. A large star ties every larger neighbour of a
    node to the node's smallest neighbour, a small star does so for the smaller
    ones. Both are a min per node (partial aggregation, so a hub is reduced
    before its shuffle) and a join back. The edge set never grows, and it ends
    as one star per component, in O(log^2 n) rounds; rounds go on until the edge
    set stands still. Only two numbers per round reach the driver.
    """
    current = staged(
        edges.select("src", "dst").where("src <> dst").select(
            F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
        ).distinct()
    )
    signature = _signature(current)
    before = None
    while signature != before:
        moved = staged(_small_star(_large_star(current)))
        release(current)
        current = moved
        before, signature = signature, _signature(current)
    members = current.select(F.col("src").alias("id"), F.col("dst").alias("component"))
    roots = current.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return members.unionByName(roots)


def extended_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Components once ``edges`` come to a graph whose components are ``labels`` (``id, component``).

    Every old star is contracted to its component first, so rounds run over the
    new edges alone, and two joins carry their outcome back.
    """
    known = labels.select("id", "component")
    ends = edges.select("src", "dst")
    for end in ("src", "dst"):
        of = known.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.join(of, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    ends = staged(ends)
    moved = connected_components(ends.select(F.col("of_src").alias("src"), F.col("of_dst").alias("dst")))
    moved = moved.select(F.col("id").alias("component"), F.col("component").alias("moved"))
    old = known.join(moved, "component", "left").select("id", F.coalesce("moved", "component").alias("component"))
    nodes = ends.select(F.col("src").alias("id")).union(ends.select("dst")).distinct().join(known.select("id"), "id", "left_anti")
    new = nodes.withColumnRenamed("id", "component").join(moved, "component").select(F.col("component").alias("id"), F.col("moved").alias("component"))
    return old.unionByName(new)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges come and go as (larger, smaller)."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    lowest = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("m"))
    return (
        both.where("dst > src")
        .join(lowest, "src")
        .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        .where("src <> dst")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("src").agg(F.min("dst").alias("m"))
    joined = edges.join(lowest, "src")
    moved = joined.select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return (
        moved.unionByName(lowest.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct()
    )
