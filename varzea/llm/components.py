"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import materialize, release

#: edges a task: a round of fewer is not dealt over more tasks, each of which would leave files of its own for every shuffle
EDGES_A_TASK = 250_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each node's larger neighbours to the least of its neighbourhood; small star: the smaller ones and itself."""
    if large:
        e = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = e.join(least, "u")
    if large:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of an edge and the least node that it reaches. Edges are (u, v) of type long.

    Each round is written to the shared folder, so a lost executor costs one round at most; it is deleted when the next is there.
    Raises if it does not settle.
    """
    e = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    last = sign(e)
    for _ in range(max_rounds):
        few = 1 + last[0] // EDGES_A_TASK
        large = _star(e.coalesce(few), True).coalesce(few).distinct().coalesce(few)
        before, e = e, materialize(_star(large, False).coalesce(few).distinct().coalesce(few), "edges")
        release(e.sparkSession, before)
        now = sign(e)
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = now
    raise RuntimeError("components did not settle")
