"""Connected components of an edge table, by alternating stars (Kiveris et al., 2014), in DataFrame joins only.

Each round replaces the edges by as many or fewer that lead more directly to the smallest node of their component;
after O(log^2) rounds every node has one edge, to that smallest node. A node's neighbours are never gathered: its
minimum is a partial aggregate, and it comes back to the edges by a join, which adaptive execution splits if a node
is in very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them; edges go from larger to smaller."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the edges (a, b) the smallest node that it is connected to. Self loops
    and repeated edges do no harm; null ends are ignored."""
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(ordered, "edges")
    was = _state(now)
    for _ in range(MAX_ROUNDS):
        if not was[0]:
            break
        after = materialize(_small_star(_large_star(now).distinct()).distinct(), "edges")
        discard(now)
        now, state = after, _state(after)
        if state == was:
            break
        was = state
    else:
        raise RuntimeError(f"the components did not settle in {MAX_ROUNDS} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
