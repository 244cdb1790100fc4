"""Connected components of edges between long integers, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import Shared


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or all but the larger) neighbours of each node to the smallest of them and the node."""
    rows = _both(edges)
    if not large:
        rows = rows.where("v < u")
    least = rows.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    near = rows.where("v > u") if large else rows.unionByName(rows.select("u", F.col("u").alias("v")).distinct())
    out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame, shared: Shared, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (u, v); component is the smallest node that can be reached.

    Edges are those of a forest of stars once a round changes nothing. Each round is written to the shared
    folder; only its size and checksum reach the driver.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges, last, name = shared.save(edges, "edges-0"), None, "edges-0"
    for i in range(1, rounds + 1):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
        edges = shared.save(_star(_star(edges, True), False), f"edges-{i}")
        shared.drop(name)
        name = f"edges-{i}"
    else:
        raise RuntimeError("the components have not settled")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
