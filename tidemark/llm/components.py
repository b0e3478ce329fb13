"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each end of an edge (a, b); ``root`` is one node of its component, the same for all.

    Each round every node hooks onto the smallest of its neighbourhood (by value first, then by a hash that
    differs from round to round, so that long paths shrink by a constant factor), and edges are rewritten to
    those parents. Stars, which the callers mostly send, take one round. All steps are joins and partial
    aggregates; each round's tables are written to the shared folder. Null ends are ignored.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), label)
    maps: list[DataFrame] = []
    turn = 0
    while True:
        rank = F.struct(F.xxhash64(F.lit(turn), "b").alias("h") if turn else F.lit(0).alias("h"), F.col("b").alias("p"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("h") if turn else F.lit(0).alias("h"), F.col("a").alias("p"))
        parents = stored(
            edges.groupBy("a").agg(F.min(rank).alias("m")).select(F.col("a").alias("node"), F.least("m", own)["p"].alias("parent")),
            label,
        )
        maps.append(parents)
        pa = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = edges.join(pa, "a").join(pb, "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        edges = stored(edges, label)
        turn += 1
        if edges.isEmpty():
            break
    out = maps[0].select("node", F.col("parent").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out
