"""Connected components of an edge table, by hooking roots and contracting the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from laurel.session import stored_copy

MAX_ROUNDS = 60


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """One row (node, component) per node of `edges`; component is the smallest node that it reaches.

    Each round hooks every root to its smallest neighbour if that is smaller, follows the hooks, and
    replaces the edges by those between different roots, so the edge table shrinks. A hot node is one
    group of a minimum, which is aggregated before the shuffle, and one side of joins that adaptive
    execution splits. Tables go to the shared folder after each round; the driver only learns whether
    any edge is left. Nulls and loops are ignored.
    """
    edges = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    links = stored_copy(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    members = None
    for _ in range(MAX_ROUNDS):
        if links.isEmpty():
            break
        hooks = stored_copy(links.groupBy("a").agg(F.min("b").alias("b")))
        # Hooks point to smaller nodes, so they hold no cycle; doubling reaches their ends.
        while True:
            onward = hooks.select(F.col("a").alias("b"), F.col("b").alias("c"))
            joined = stored_copy(hooks.join(onward, "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")))
            hooks = joined.select("a", "b")
            if joined.where("moved").isEmpty():
                break
        roots = hooks.select(F.col("a").alias("node"), F.col("b").alias("root"))
        if members is None:
            members = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
        else:
            far = hooks.select(F.col("a").alias("component"), F.col("b").alias("root"))
            members = members.join(far, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        members = stored_copy(members)
        start = hooks.select(F.col("a").alias("x"), F.col("b").alias("to_a"))
        end = hooks.select(F.col("a").alias("y"), F.col("b").alias("to_b"))
        moved = (
            links.join(start, links.a == F.col("x"), "left")
            .join(end, links.b == F.col("y"), "left")
            .select(F.coalesce("to_a", "a").alias("p"), F.coalesce("to_b", "b").alias("q"))
            .where("p <> q")
        )
        links = stored_copy(moved.select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct())
    else:
        raise RuntimeError(f"edges are left after {MAX_ROUNDS} rounds")
    if members is None:
        return nodes.select("node", F.col("node").alias("component"))
    return members
