"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import Workspace


def components(ws: Workspace, edges: DataFrame, name: str, rounds: int = 50) -> DataFrame:
    """(id, comp): comp is the smallest id reachable. ``edges`` holds (u, v); ids without edges are not returned.

    Each step keeps at most as many edges as it gets, pre-aggregates the minimum before its shuffle and writes its edges
    to the shared folder, so that a lost executor repeats one step. No component is gathered into one task.
    """
    edges = ws.keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    seen = None
    for k in range(1, rounds + 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        step = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        step = ws.keep(step, f"{name}-{k}")
        now = step.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        ws.drop(f"{name}-{k - 1}")
        edges = step
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("comp"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots).groupBy("id").agg(F.min("comp").alias("comp"))
