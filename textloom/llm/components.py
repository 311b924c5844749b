"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import written


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node that it can reach. Loops and nulls are ignored.

    A large-star step hangs each larger neighbour of a node on the least of its neighbours and itself, a small-star step the smaller ones.
    Both keep components and end, after about log(n) steps, in stars. The minima are combined before the shuffle; the join back to
    the edges is a plain equi-join, which the adaptive planner splits where a hub is hot. Each step is written to the shared folder.
    """
    edges = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    stamp = _stamp(edges)
    for _ in range(max_steps):
        if not stamp[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").filter("a != b").distinct(), "edges")
        before, stamp = stamp, _stamp(edges)
        if stamp == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
