"""Connected components of an undirected graph held as an edge DataFrame.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014): each round is a couple of
``groupBy(node).min`` aggregations and joins, the number of rounds grows
with log(n) instead of the graph diameter, and every round is checkpointed to
the shared checkpoint folder so a lost executor never replays the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _orient(e: DataFrame) -> DataFrame:
    """(u, v) with u > v, no self loops, no duplicates."""
    return (e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(m, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _orient(out)


def _small_star(e: DataFrame) -> DataFrame:
    # e is oriented: u > v
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    j = e.join(m, "u")
    out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        j.select("u", F.col("m").alias("v")))
    return _orient(out)


def connected_components(edges: DataFrame, vertices: DataFrame | None = None,
                         src: str = "src", dst: str = "dst", vid: str = "id") -> DataFrame:
    """(id, component) where component = smallest vertex id of the component.
    ``vertices`` adds isolated vertices (their own component)."""
    e = cut_lineage(_orient(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))))
    while True:  # every round shortens the longest path; it ends when all edges form stars
        e = cut_lineage(_small_star(_large_star(e)))
        # converged when the edges form stars: each node has one target and
        # no target is itself the source of an edge
        sig = e.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("nu")).first()
        if sig["n"] == sig["nu"]:
            chained = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
            if chained == 0:
                break
    comp = e.select(F.col("u").alias(vid), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias(vid)).distinct().select(vid, F.col(vid).alias("component"))
    out = comp.unionByName(roots).groupBy(vid).agg(F.min("component").alias("component"))
    if vertices is not None:
        v = vertices.select(F.col(vertices.columns[0]).alias(vid))
        out = v.join(out, vid, "left").select(vid, F.coalesce("component", F.col(vid)).alias("component"))
    return out
