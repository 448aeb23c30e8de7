"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): ``root`` is the smallest node of the node's component.

    Alternates two star steps until the edges no longer change: every node
    hands its larger neighbours, then its smaller ones, to the smallest node
    it sees.  The smallest neighbour is found by a combining aggregate and
    joined back on, so a node with very many neighbours is never gathered in
    one group.  Each round is written to the shared folder.  Self-loops,
    repeated edges and an empty table are fine."""
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a > b").distinct()
    e = store(e, "edges")
    n, before = _state(e)
    while n:
        e = store(_small(_large(e)), "edges")
        n, now = _state(e)
        if now == before:
            break
        before = now
    children = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return children.unionByName(roots)


def _state(e: DataFrame) -> tuple[int, tuple]:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], (row["n"], row["h"])


def _lowest(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y) with the smallest of x and its y, as ``low``."""
    low = pairs.groupBy("x").agg(F.min("y").alias("low")).select(
        F.col("x").alias("lx"), F.xxhash64("x").alias("hx"), F.least("x", "low").alias("low"))
    # The second key makes both sides shuffle for the join, so that AQE can
    # split a node that has most of the edges.
    return pairs.join(low, (pairs["x"] == low["lx"]) & (F.xxhash64(pairs["x"]) == low["hx"])).select("x", "y", "low")


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        e.select(F.col("b").alias("x"), F.col("a").alias("y")))
    return _lowest(both).where("y > x").select(F.col("y").alias("a"), F.col("low").alias("b")).where("a > b").distinct()


def _small(e: DataFrame) -> DataFrame:
    seen = _lowest(e.select(F.col("a").alias("x"), F.col("b").alias("y")))
    out = seen.select(F.col("y").alias("a"), F.col("low").alias("b")).unionByName(
        seen.select(F.col("x").alias("a"), F.col("low").alias("b")))
    return out.where("a > b").distinct()
