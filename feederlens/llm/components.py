"""Connected components of a graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import discard, join_unique, spread, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours of a node to its smallest neighbour: the larger ones in a large star, the
    smaller ones and the node itself in a small star. No task holds the neighbours of a node."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = join_unique(both, low, ["u"], spread("v"))
    if large:
        made = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
    return made.where("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Each node that has an edge (columns a, b) with the smallest node of its component.

    Returns (node, component). Null ends and loops are left out; an empty table gives an empty one.
    Rounds go on until the edges stay the same; the driver sees a count and a sum per round."""
    now = staged(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        seen, before = state, now
        now = staged(_star(_star(before, large=True), large=False), "edges")
        discard(before)
    raise RuntimeError("components did not settle")
