"""Connected components by alternating large and small stars.

Every round joins the edges with the least neighbour of each node. The least
neighbours are pre-aggregated and written, so that in the join a node with very
many neighbours is a plain shuffled side, which Spark splits where it is
skewed. Rounds grow with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.common import written


def components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b; long): root is the least node reachable. Edges with a null end are left out."""
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for k in range(max_rounds):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "b > a")
        large = written(large.distinct(), f"large-star-{k}")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"small-least-{k}")
        small = _to_least(large, least, "true").unionByName(least.select("a", F.col("m").alias("b")))
        small = small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        # A round has no more edges than the one before; few edges make few files.
        now = written(small.coalesce(1 + state[0] // 200_000), f"edges-{k}")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _to_least(edges: DataFrame, least: DataFrame, which: str) -> DataFrame:
    """Edges (a, b) that hold `which`, turned to lead from b to the least neighbour m of a."""
    joined = edges.join(written(least, "least"), "a")
    return joined.filter(which).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def with_least(nodes: DataFrame, roots: DataFrame, node_col: str, id_col: str) -> DataFrame:
    """(node, component_id) for each of `nodes` that `roots` (node, root) holds: the least `id_col` of all nodes with that root."""
    rooted = written(nodes.select(F.col(node_col).alias("node"), F.col(id_col).alias("id")).join(roots, "node"), "rooted")
    first = written(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "first-of-root")
    return written(rooted.join(first, "root").select("node", "component_id"), "component-ids")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
