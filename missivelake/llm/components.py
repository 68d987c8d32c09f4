"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped aggregation and a join; nothing is collected but two counters a round.  The edge
table is written to the shared folder each round, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, setting, written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours to the least of them: the larger neighbours, or the smaller ones and the node."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u"), F.col("m")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a bigint, b bigint); component is the least node."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        before, edges = edges, written(_star(_star(edges, True), False), "edges")
        discard(before)
        # A star forest is stable under both steps: each node has one edge and roots have none upward.
        with setting(edges.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
