"""Connected components of links between long ids, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, remove, write_table


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, component) of every id in ``links`` (a, b), and where it is written; component is the smallest id reachable.

    Each round every id points to its smallest neighbour if that is smaller,
    pointers are followed to their ends (doubling each step), and links are
    rewritten between ends. Neighbourhoods are only ever reduced to a
    minimum, so an id with any number of links is no bottleneck. Every step
    is a table written to the shared folder.
    """
    spark = links.sparkSession
    edges = links.select("a", "b").filter("a <> b")
    edges, edges_at = write_table(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    found = None
    old: list[str] = []
    while not edges.isEmpty():
        ends, ends_at = write_table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("end"))
                                    .select("node", F.least("node", "end").alias("end")), "cc-ends")
        while True:
            # Twice as far, and twice again.
            once = ends.join(ends.select(F.col("node").alias("end"), F.col("end").alias("e2")), "end").select("node", "e2")
            further = once.select(F.col("node").alias("e2"), F.col("e2").alias("e4"))
            jumped, at = write_table(once.join(further, "e2").select("node", F.col("e4").alias("end"), (F.col("e4") != F.col("e2")).alias("moved")), "cc-ends")
            old.append(ends_at)
            ends, ends_at = jumped.select("node", "end"), at
            if jumped.filter("moved").isEmpty():
                break
        old.append(ends_at)
        if found is None:
            found = ends.select("node", F.col("end").alias("component"))
        else:
            move = ends.select(F.col("node").alias("component"), "end")
            found = found.join(move, "component", "left").select("node", F.coalesce("end", "component").alias("component"))
        left = ends.select(F.col("node").alias("a"), F.col("end").alias("ea"))
        right = ends.select(F.col("node").alias("b"), F.col("end").alias("eb"))
        old.append(edges_at)
        edges, edges_at = write_table(edges.join(left, "a").join(right, "b").filter("ea <> eb")
                                      .select(F.col("ea").alias("a"), F.col("eb").alias("b")).distinct(), "cc-edges")
        release(spark)
    old.append(edges_at)
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found, found_at = write_table(found, "cc-found")
    remove(spark, *old)
    return found, found_at
