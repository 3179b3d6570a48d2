"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import written


def _mins(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node, itself included (map-side combined)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node that each node of an edge reaches.

    Alternates large-star (every larger neighbour of a node is linked to the
    node's smallest neighbour) and small-star (every smaller neighbour and the
    node itself are) until the edges no longer change; a logarithmic number of
    rounds in practice. Only edges and per-node minima are shuffled: no
    neighbour list is ever gathered. Each round is a written table. A null end
    drops the edge; self-loops give their node.
    """
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    cur = written(cur, "edges")
    mark = None
    for _ in range(rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_mins(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(cur.where("u = v"))
        large = written(large.distinct(), "edges")
        low = _mins(large)
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        cur = written(small.distinct(), "edges")
        now = cur.where("u <> v").agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
