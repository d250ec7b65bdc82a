"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Edges of a written file, and the files of a round at least.
FILE_EDGES, FILES = 1 << 18, 8


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids -> (node, root): every node that has an edge, with the least id of
    its component.

    Alternating stars: a large-star step links a node's greater neighbours to its least neighbour,
    a small-star step links its lesser ones. Each is one exchange by node and a window, so all
    edges of a hub meet in one task (a few long numbers each, which may spill). The rounds grow with the logarithm of
    a component's size; each is written to the shared folder, to as many files as its edges fill. The round
    that reads nothing but stars is the last one. No edges: no rows.
    """
    at = Window.partitionBy("u")
    e = materialise(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    n, more = e.count(), True
    while more:
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x"))
        near = (both.select("x.*").repartition("u").distinct()
                .select("u", "v", F.min("v").over(at).alias("low"), F.max("v").over(at).alias("high")))
        # in a star, a node with a lesser neighbour has no other one; its edge to the least stays, to tell of it
        near = near.withColumn("more", F.expr("low < u AND low < high")).filter("v > u OR more AND v = low")
        large = near.select(F.greatest("u", "v").alias("u"), F.expr("CASE WHEN v > u THEN least(u, low) ELSE v END AS v"), "more")
        near = large.repartition("u").distinct().select("u", "v", "more", F.min("v").over(at).alias("m"))
        pairs = F.array(F.struct("u", F.col("m").alias("v"), "more"), F.struct(F.col("v").alias("u"), F.col("m").alias("v"), "more"))
        e = near.select(F.explode(pairs).alias("x")).select("x.*").filter("u > v").distinct()
        e = materialise(e.coalesce(max(FILES, -(-n // FILE_EDGES))), "edges")
        n, more = e.agg(F.count("*"), F.max("more")).first()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
