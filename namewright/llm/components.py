"""Connected components of a graph given as a table of links, by contraction in written steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the smallest node reachable from it.

    Every node hooks to its smallest neighbour unless it is the smallest itself; the trees are flattened by doubling; the
    links are then rewritten to roots, and what still joins different roots is treated the same way. At least half the
    nodes of a component vanish per round. Each step is written, so lost executors cost none before it.
    A node with very many links is reduced before it is shuffled, or split by adaptive execution. Links from a node to itself
    and repeated ones do no harm; an empty table gives an empty result.
    """
    links = _kept(links.select("a", "b").where("a <> b").distinct())
    roots = None
    while roots is None or not links.isEmpty():
        both = links.union(links.select("b", "a"))
        tree = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
        tree = _flattened(_kept(tree))
        if roots is None:
            roots = tree
        else:
            above = tree.select(F.col("node").alias("of"), F.col("root").alias("next"))
            roots = roots.join(above, F.col("root") == F.col("of"), "left")
            roots = _kept(roots.select("node", F.coalesce("next", "root").alias("root")))
        for end in ("a", "b"):
            own = tree.select(F.col("node").alias("of"), F.col("root").alias("to"))
            links = links.join(own, F.col(end) == F.col("of")).withColumn(end, F.col("to")).drop("of", "to")
        links = _kept(links.where("a <> b").distinct())
    return roots


def _kept(df: DataFrame) -> DataFrame:
    return written(df, "links", few_files=True)


def _flattened(tree: DataFrame) -> DataFrame:
    while True:
        above = tree.select(F.col("node").alias("of"), F.col("root").alias("next"))
        step = tree.join(above, F.col("root") == F.col("of"), "left")
        step = step.select("node", F.col("root").alias("was"), F.coalesce("next", "root").alias("root"))
        step = _kept(step)
        tree = step.select("node", "root")
        if step.where("was <> root").isEmpty():
            return tree
