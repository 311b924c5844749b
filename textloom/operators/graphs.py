"""Relations between records: symmetric closure, defects, and reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.sources.shared import written


def relation_defects(edges: DataFrame, nodes: DataFrame, child: str = "child", parent: str = "parent", node: str = "node") -> DataFrame:
    """(child, defect): parents that don't exist, and children of several parents."""
    dangling = edges.join(nodes.select(F.col(node).alias(parent)), parent, "left_anti").select(child, F.lit("dangling_parent").alias("defect"))
    several = edges.distinct().groupBy(child).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(child, F.lit("several_parents").alias("defect"))
    return dangling.distinct().unionByName(several)


def descendants(edges: DataFrame, child: str = "child", parent: str = "parent", max_rounds: int = 10_000) -> DataFrame:
    """(ancestor, node, depth): all pairs of which the one is reached from the other, at their least depth, however deep.

    Each round joins the pairs found last with the edges and keeps the new ones, so a pair is extended once even where many paths
    lead to it, cycles end, and there are as many rounds as the longest of the least depths.
    """
    steps = edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).filter("p IS NOT NULL AND c IS NOT NULL").distinct()
    last = written(steps.select(F.col("p").alias("ancestor"), F.col("c").alias("node"), F.lit(1).alias("depth")), "reached")
    found = last
    for depth in range(2, max_rounds):
        ahead = last.join(steps, last["node"] == steps["p"]).select("ancestor", F.col("c").alias("node")).distinct()
        last = written(ahead.join(found.select("ancestor", "node"), ["ancestor", "node"], "left_anti").withColumn("depth", F.lit(depth)), "reached")
        if last.isEmpty():
            return found
        found = found.unionByName(last)
    raise RuntimeError(f"not settled in {max_rounds} rounds")


def on_cycles(parents: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node): the nodes that are on a cycle, each node having one parent at most.

    Jumps double: after k rounds a node points 2^k parents up. Once that is more than there are nodes, only cycles are left to point at.
    """
    steps = parents.select(F.col(node).alias("n"), F.col(parent).alias("up")).filter("up IS NOT NULL")
    steps = written(steps, "jumps")
    for _ in range(max(1, steps.count()).bit_length()):
        above = steps.select(F.col("n").alias("up"), F.col("up").alias("further"))
        steps = written(steps.join(above, "up").select("n", F.col("further").alias("up")), "jumps")
    return steps.select(F.col("up").alias(node)).distinct()


def normalised(rows: DataFrame, node: str = "node", parent: str = "parent", children: str = "children") -> tuple[DataFrame, DataFrame]:
    """((node, parent), (node, error)): links given by either end made one parent a node, and what is wrong with them.

    Errors are parents and children that don't exist, children that several nodes claim, and nodes on cycles. Of several claims a node's own parent counts, then the least.
    """
    own = rows.select(F.col(node).alias("n"), F.col(parent).alias("p"))
    claims = rows.select(F.col(node).alias("p"), F.explode(F.array_distinct(F.coalesce(children, F.array().cast(rows.schema[children].dataType)))).alias("n"))
    nodes = own.select("n").distinct()
    dangling = own.filter("p IS NOT NULL").join(nodes.withColumnRenamed("n", "p"), "p", "left_anti").select("n", F.concat(F.lit("dangling parent "), "p").alias("error"))
    lost = claims.join(nodes, "n", "left_anti").select(F.col("p").alias("n"), F.concat(F.lit("dangling child "), "n").alias("error"))
    links = own.filter("p IS NOT NULL").select("n", "p", F.lit(0).alias("of")).unionByName(claims.select("n", "p", F.lit(1).alias("of"))).join(nodes, "n").join(nodes.withColumnRenamed("n", "p"), "p")
    chosen = links.groupBy("n").agg(F.min_by("p", F.struct("of", "p")).alias("p"), F.count_distinct("p").alias("parents"))
    several = chosen.filter("parents > 1").select("n", F.lit("belongs to several parents").alias("error"))
    tree = nodes.join(chosen, "n", "left").select(F.col("n").alias(node), F.col("p").alias(parent))
    turning = on_cycles(tree, node, parent).select(F.col(node).alias("n"), F.lit("relation cycle").alias("error"))
    errors = dangling.unionByName(lost).unionByName(several).unionByName(turning).distinct().withColumnRenamed("n", node)
    return tree, errors
