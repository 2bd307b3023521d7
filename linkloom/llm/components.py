"""Connected components of a link table, by alternating stars.

Each round joins every node's larger neighbours, then every node's smaller ones, to
the smallest of its neighbourhood, until all links lead from a component's smallest
node to its other nodes. Links stay in Spark; only their number and a checksum reach
the driver. A hub's links are spread by ``attach``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, stage


def _least(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (u, v) with ``m``, the least of u and all its v."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("rows"))
    found = attach(rows, least, ["u"], "rows", total, ["v"])
    return found.select("u", "v", F.least("u", F.col("_found.m")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (columns a, b: two long numbers); the
    root is the smallest node reachable. Links of a node with itself only name it."""
    alone = links.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("root"))
    rows = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    before = None
    while True:
        rows = stage(rows, "links")
        state = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = rows.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(rows.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _least(both, 2 * state["n"]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large, state["n"])
        rows = (
            small.select(F.col("m").alias("a"), F.col("u").alias("b"))
            .unionByName(small.select(F.col("m").alias("a"), F.col("v").alias("b")))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
    nodes = rows.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = rows.select(F.col("a").alias("node"), F.col("a").alias("root")).unionByName(alone).distinct()
    return nodes.unionByName(roots.join(nodes, "node", "left_anti"))
