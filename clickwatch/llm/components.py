"""Connected components by alternating large and small stars over shuffled edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwatch.session import stage


def _minima(edges: DataFrame) -> DataFrame:
    """Every edge of `edges` (u, v) with `m`, the smallest of u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(smallest, "u").select("u", "v", F.least("u", "least").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the smallest one around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _minima(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    moved = _minima(down)
    heads = moved.select("u", F.col("m").alias("v"))
    return moved.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(heads).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node in `links`, root being the smallest node reachable.

    A round halves distances at least; each is written to the shared folder, so a lost
    executor costs one round. Loops and repeated links do no harm; nodes without a
    link to another node do not appear. No rows in, no rows out.
    """
    edges = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v"), "links")
    before = None
    for _ in range(max_rounds):
        edges = stage(_small_star(_large_star(edges)), "stars")
        # an order-free digest of the edge set: unchanged means every node points at its root
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
