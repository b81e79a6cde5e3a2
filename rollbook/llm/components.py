"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import written


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node reachable.

    Rounds of linking larger neighbours to the least one, then smaller ones to the least one, until nothing changes.
    Each round reduces per node with partial sums before its shuffle, and writes its links, so a node with very many
    links costs a task only one value from each other task. Both steps keep every component connected.
    """
    key = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    links = written(
        edges.where("a <> b").select(key(F.col("a"), F.col("b")).alias("e")).select("e.a", "e.b").distinct(), "links"
    )
    for _ in range(limit):
        # Large: every neighbour above a node goes to the least of the node and its neighbours.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Small: a node and its neighbours below go to the least of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        new = (
            small.select(F.col("m").alias("a"), "b")
            .unionByName(small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")))
            .distinct()
        )
        new = written(new, "links")
        # Stars only, and no node both centre and leaf: done.
        ends = new.select(F.col("b").alias("n"), "a")
        ends = ends.unionByName(new.select(F.col("a").alias("n"), "a"))
        seen = ends.groupBy("n").agg(F.min("a").alias("x"), F.max("a").alias("y"))  # a leaf of two, or centre and leaf
        settled = not seen.where("x <> y").limit(1).count()
        links = new
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
