"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_hot, settle


def _lowest(pairs: DataFrame) -> DataFrame:
    """For each u: the least of u and its neighbours, and its rows.  A partial aggregate, so a hub costs no task its whole row list."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return join_hot(both, _lowest(both), ["u"], 2 * rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    return join_hot(down, low, ["u"], rows).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its least node.

    Each round is two shuffled star steps settled in the shared scratch folder;
    rounds grow with the logarithm of the longest path.  Loops and nulls are ignored.
    """
    cur = settle(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    seen, rows = None, cur.count()
    for _ in range(max_rounds):
        large = settle(_large_star(cur, rows).distinct())
        new = settle(_small_star(large, large.count()).distinct())
        discard(cur, large)
        cur = new
        now = cur.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == seen:
            break
        seen, rows = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(cur.select("v", "v").distinct())
