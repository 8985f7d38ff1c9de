"""Connected components by alternating large and small stars, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskstream.llm.common import written

SALTS = 32


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (a, b): root is the smallest node that it reaches.

    Both stars point a node's neighbours at its smallest neighbour: the large star those that are
    larger than the node, the small star the rest and the node itself. Repeated until nothing moves,
    every component is a star around its root. The minimum of a node is sent to `SALTS` parts of
    its neighbours, so the centre of a star is no single task. No edge: no row.
    """
    current = written(_unlike(edges.select("a", "b")), "edges")
    seen = None
    while True:
        both = current.union(current.select("b", "a"))
        current = written(_unlike(_to_smallest(both).where("v > u").selectExpr("v AS a", "least(m, u) AS b")), "edges")
        down = current.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
        stars = _to_smallest(down)
        current = written(_unlike(stars.selectExpr("u AS a", "m AS b").union(stars.selectExpr("v", "m"))), "edges")
        state = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen:
            return current.selectExpr("a AS node", "b AS root").union(
                current.selectExpr("b", "b").distinct())
        seen = state


def _unlike(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with m, the smallest neighbour of u."""
    edges = edges.toDF("u", "v")
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Merged: an estimate of the copies from file sizes would be far too small for a broadcast.
    return edges.withColumn("part", F.pmod(F.hash("v"), F.lit(SALTS))).join(least.hint("merge"), ["u", "part"])
