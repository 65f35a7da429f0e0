"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common


HUBS = 50_000       # bound on the vertices whose smallest neighbour is broadcast
HUB_EDGES = 256     # a vertex of fewer edges is no hub


def _smallest(edges: DataFrame) -> DataFrame:
    """``(_u, _m, _n)``: smallest of each vertex and its neighbours ``v``, and
    their number."""
    return edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("_n")).select(
        "_u", F.least("_u", "_m").alias("_m"), "_n")


def _met(edges: DataFrame, least: int) -> DataFrame:
    """Edges with the smallest neighbour ``_m`` of their ``u``.  Vertices of
    more than ``least`` edges are broadcast, so that a hub's edges stay where
    they are; the other edges meet theirs by shuffle."""
    ends = _smallest(edges)
    hubs = F.broadcast(ends.filter(F.col("_n") > least).drop("_n"))
    at_hub = F.col("u") == F.col("_u")
    rest = ends.filter(F.col("_n") <= least).drop("_n")
    return edges.join(hubs, at_hub).unionByName(edges.join(hubs, at_hub, "left_anti").join(rest, at_hub))


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` for the vertices of ``(u, v)`` edges, the
    component being its smallest vertex.

    Each round connects larger neighbours of a vertex (large star), then
    smaller ones (small star), to the smallest; the edges become stars in a
    logarithmic number of rounds.  A vertex's smallest neighbour is a map-side
    combined minimum.  A vertex with more than one in ``HUBS`` of all edge ends
    is a hub, so there are fewer than ``HUBS`` of them however large the graph;
    they are broadcast and a hub's edges never meet in one task.  Every round is
    written to the shared folder; only counts reach the driver.  Loops and null
    ends are ignored."""
    clean = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
             .filter("u > v").distinct())
    now = common.stored(clean, "edges")
    seen = None
    n = now.count()
    while True:
        least = max(HUB_EDGES, -(-2 * n // HUBS))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_met(both, least).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("_m").alias("v")).filter("u != v").distinct())
        large = common.stored(large, "large-star")
        near = _met(large, least)
        small = (near.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("_m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("_m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u != v").distinct())
        now = common.stored(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, n = state, state[0]
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots)
