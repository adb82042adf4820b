"""Connected components by alternating large-star and small-star steps (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize


def _minima(edges: DataFrame) -> DataFrame:
    """For each node the least node among itself and its neighbours; combined on the map side, so hubs cost no more."""
    both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    return both.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """Components of an undirected graph given as edges between values of one ordered type.

    Returns (node, component), one row per node that occurs in an edge; ``component`` is the least node of it.
    Edges with a null end are left out, loops keep their node, parallel edges count once, no edges give no rows.
    Each round has two joins on the node, which adaptive execution splits where a hub is hot; no neighbour list is
    ever collected. Rounds grow with the logarithm of the diameter.
    """
    start = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    # every edge points from the larger node (a) to the smaller one (b); loops only keep their node
    given = materialize(start.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = given.select(F.col("a").alias("node")).union(given.select(F.col("b").alias("node"))).distinct()
    current = given.where("a <> b")
    for _ in range(max_rounds):
        # large star: link each neighbour greater than n to the least of n's neighbourhood
        low = _minima(current)
        both = current.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(current.select(F.col("b").alias("n"), F.col("a").alias("m")))
        large = both.join(low.withColumnRenamed("m", "low"), "n").where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b")).distinct()
        # small star: link the smaller neighbours of n, and n, to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        linked = large.join(least, "a")
        small = linked.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b"))).distinct()
        following = materialize(small, "edges")
        # stars are a fixed point: no child has two parents, and none is a parent itself
        roles = following.groupBy("a").agg(F.count("*").alias("up"), F.lit(0).alias("down")).unionByName(following.groupBy(F.col("b").alias("a")).agg(F.lit(0).cast("long").alias("up"), F.lit(1).alias("down")))
        still = roles.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").take(1)
        drop_materialized(current)
        current = following
        if not still:
            break
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    return nodes.join(current.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
