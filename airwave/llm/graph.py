"""Connected components by alternating stars, on Spark only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import drop_stage, stage


def star(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link each node's neighbours to the least node among it and them.

    Large star links only the neighbours above the node, small star only those
    below it (and the node itself).  The least neighbour is an aggregate, and
    the join back is on the node.
    """
    if smaller_only:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if smaller_only:
        linked = joined.select(F.col("b").alias("x"), "m").unionByName(joined.select(F.col("a").alias("x"), "m"))
    else:
        linked = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "m")
    return linked.where(F.col("x") != F.col("m")).select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the least node.

    Rounds of a large star and a small star until the edges stop changing,
    which takes about log2 of the longest path.  Each round is written to the
    shared checkpoint folder; the round before is deleted.  A round's change is
    seen in two sums over its edges, so no edge leaves the executors.
    """
    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                            F.bit_xor(F.xxhash64("b", "a"))).first())

    now = stage(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    seen = mark(now)
    while seen[0]:
        after = stage(star(star(now, False), True))
        found = mark(after)
        drop_stage(now)
        now = after
        if found == seen:
            break
        seen = found
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
