"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def rooted(pointers: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) of a forest of pointers (id, to), where to is less than id: each round makes a pointer span four times as much."""
    pointers = common.saved(pointers)
    for _ in range(max_rounds):
        n = pointers.count()
        jumped = pointers.withColumn("moved", F.lit(False))
        for _ in range(2):
            ahead = pointers.select(F.col("id").alias("to"), F.col("to").alias("far"))
            jumped = common.join_small(jumped, ahead, "to", "left", n).select("id", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved"))
        jumped = common.saved(jumped)
        pointers = jumped.select("id", "to")
        if not common.some(jumped.filter("moved")):
            return pointers.withColumnRenamed("to", "root")
    raise RuntimeError("pointers did not settle")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, label) of every id in links (a written table of a, b): label is the least id that can be reached.

    In a round every id points to its least neighbour below it, the trees that arise
    become one id each, and the links between trees go on as links of a smaller graph;
    links within a tree are done. At least half of the ids with links go in a round,
    and each table is written, so lineage stays short.
    """
    links = links.select("a", "b")
    labels, edges = None, links.filter("a <> b")
    for _ in range(max_rounds):
        if not common.some(edges):
            break
        pointers = edges.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("to")).groupBy("id").agg(F.min("to").alias("to"))
        roots = rooted(pointers)
        n = roots.count()
        top = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root"))  # noqa: E731,B023
        moved = common.join_small(common.join_small(edges, top("a"), "a", "left", n), top("b"), "b", "left", n)
        edges = common.saved(moved.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).filter("a <> b").distinct())
        if labels is None:
            labels = roots.select("id", F.col("root").alias("label"))
        else:
            labels = common.join_small(labels, roots.select(F.col("id").alias("label"), "root"), "label", "left", n).select("id", F.coalesce("root", "label").alias("label"))
            labels = common.saved(labels.unionByName(roots.select("id", F.col("root").alias("label"))).groupBy("id").agg(F.min("label").alias("label")))
    else:
        raise RuntimeError("components did not settle")
    every = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
    if labels is None:
        return common.saved(every.withColumn("label", F.col("id")))
    return common.saved(common.join_small(every, labels, "id", "left").select("id", F.coalesce("label", "id").alias("label")))
