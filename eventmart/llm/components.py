"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` to a star per component: ``u`` and its least node ``v``.

    Nodes that are the least of their component, or have no edge, have no row. Each step
    joins edges with the least neighbour of their node, so a node of many edges is spread
    by the join's skew handling; nothing but two numbers of a step reaches the driver.
    """
    current = materialize(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "component-edges",
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(nearest, "u")
            .filter(F.col("v") > F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(nearest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = materialize(small, "component-edges")
        state = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if state == before:
            return current
        before = state
