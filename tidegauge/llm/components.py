"""Connected components of a graph that only Spark holds, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import drop_staged, staged


def _mark(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart without moving them."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links every neighbour of a node (the larger ones, or the node and its smaller ones) to the smallest of them all."""
    around = edges if not larger_only else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = around.join(least, F.col("a") == F.col("node"))
    if larger_only:
        linked = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    return linked.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the edges ``a, b``, of any type that has an order.

    Each round at least halves the depth of what is not yet a star, so a few rounds do; every round is a written table, and
    the table before it goes.  Loops and repeated edges are allowed; no edges give no rows.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = staged(now, "components")
    mark = _mark(now)
    while mark[0]:
        after = staged(_star(_star(now, True), False), "components")
        drop_staged(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
