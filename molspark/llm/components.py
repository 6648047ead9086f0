"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molspark.session import materialised

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    return (
        both.where("b > a")
        .join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("n"))
    hung = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of longs to (node, root), for every linked node; root is its smallest reachable.

    Null ends and self links are ignored. Each round is grouping and joining of the link table,
    written to the shared folder; two numbers per round reach the driver. A node of very many links
    only meets others through partial minima, and the joins are plain equi-joins that adaptive
    execution splits. No links give no rows.
    """
    state = materialised(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        state = materialised(_small_star(_large_star(state)))
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
    raise RuntimeError("Components did not settle.")
