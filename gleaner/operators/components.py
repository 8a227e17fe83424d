"""Connected components by alternating star contraction.

Every round links each node to the least node it knows (large star), then links
the lesser neighbours of a node to the least of them (small star), until only
stars are left; rounds grow with the logarithm of a component's diameter. Nodes
and edges stay distributed. The minima of each step are written before they are
joined, so that both sides of the join are plain shuffles, which adaptive
execution can split where one node holds a large share of the edges. They are never
broadcast, which would cost the driver a table in every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has an edge to another node; the
    component is its least node. Null ends and loops are ignored; no edges give
    no rows."""
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull().alias("_a"), F.col(b).isNotNull().alias("_b"))
    now = scratch.write(ends.where(F.col("_a") & F.col("_b") & (F.col("u") != F.col("v"))).select("u", "v").distinct(), "edges")
    while True:
        both = now.select(F.col("u").alias("n"), F.col("v").alias("o")).union(now.select(F.col("v").alias("n"), F.col("u").alias("o")))
        least = scratch.write(both.groupBy("n").agg(F.min("o").alias("m")).where(F.col("m") < F.col("n")), "large-least")
        moved = now.join(least.hint("merge"), now.v == least.n, "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved"))
        large = scratch.write(moved.groupBy("u", "v").agg(F.max("moved").alias("moved")), "large")
        least2 = scratch.write(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).where("c > 1").select(F.col("u").alias("n"), "m"), "small-least")
        settled = not large.where("moved").head(1) and not least2.head(1)
        if settled:
            scratch.drop(now, least, least2)
            return large.select(F.col("u").alias("node"), F.col("v").alias("component")).union(large.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        joined = large.join(least2.hint("merge"), large.u == least2.n, "left").select("u", "v", "m")
        small = joined.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.coalesce("m", "v").alias("v")),
            F.struct(F.col("v").alias("u"), F.coalesce("m", "v").alias("v")),
        )).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        after = scratch.write(small, "small")
        scratch.drop(now, least, large, least2)
        now = after
