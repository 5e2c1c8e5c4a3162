"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node with an edge to another, the smallest node it can reach.

    Each round is two grouped minima and two joins back; the edges are written to the shared
    scratch folder after each, so that a lost executor costs one round.  Edges only ever move
    towards smaller nodes and stop changing when every component is a star round its root.
    Loops and rows with a null are ignored.
    """
    hi, lo = F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    now = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialize(now.select(hi, lo).distinct(), "cc")
    n_now = now.count()
    while True:
        # large star: every larger neighbour of u is tied to the smallest of u and its neighbours
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: u and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        tied = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo")
        new = materialize(tied.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "cc")
        # the edges are stars round their roots as soon as a round leaves every one of them as it was
        n_new = new.count()
        if n_new == n_now and new.join(now, ["hi", "lo"], "left_anti").isEmpty():
            roots = new.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            return new.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
        now, n_now = new, n_new
