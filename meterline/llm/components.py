"""Connected components by local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every id in links (columns a and b).

    In each round every vertex looks up its first neighbour, in an order drawn anew for the round, and that one's first
    neighbour, and joins whichever of the two comes first; edges between vertices that joined the same one vanish. So a
    star, whatever its size, is one vertex after one round, and the last vertex in the order of any component vanishes.
    A hub's edges are summed before they are shuffled, and joins on hubs are ones whose skew Spark splits.
    """
    edges = settle(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    labels: DataFrame | None = None
    turn = 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), "b")).alias("near")
        near = settle(both.groupBy("a").agg(first), "near")
        after = near.select(F.col("a").alias("next"), F.col("near").alias("far"))
        met = near.select("a", "near", F.col("near.b").alias("next")).join(after, "next")
        joins = settle(met.select(F.col("a").alias("id"), F.least("near", "far")["b"].alias("root")), "joins")
        if labels is None:
            labels = joins
        else:
            found = labels.withColumnRenamed("root", "middle").join(joins.withColumnRenamed("id", "middle"), "middle", "left")
            labels = settle(found.select("id", F.coalesce("root", "middle").alias("root")), "labels")
        left, right = joins.toDF("a", "x"), joins.toDF("b", "y")
        edges = settle(
            edges.join(left, "a").join(right, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        if edges.isEmpty():
            break
        turn += 1
    least = labels.groupBy("root").agg(F.min("id").alias("component"))
    return settle(labels.join(least, "root").select("id", "component"), "components")
