"""Connected components of an edge table, in rounds of joins over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import stages


#: Edges up to which a round's table of least neighbours (at most two rows an edge) is broadcast; beyond, it is joined by shuffle.
BROADCAST_EDGES = 300_000


def _with_least(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    return edges.join(F.broadcast(least) if small else least, "a")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return _with_least(both.where(F.col("b") > F.col("a")), least, small).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the least of them. Expects a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(edges, least, small).where(F.col("b") > F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _summary(links: DataFrame) -> tuple:
    """Number of links and a sum that tells two sets of them apart."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the edges; a component is named by its least node.

    The edges may repeat, point either way or join a node to itself; edges with
    a NULL end are left out, and a node with a loop only is its own component.
    Each round keeps at most one edge per node and neighbour and is written to
    the shared folder, so a lost executor costs one round; the rounds grow with
    the logarithm of the longest chain. No node's neighbours are ever gathered:
    popular nodes are only aggregated, or joined with their one least neighbour.
    """
    spark = edges.sparkSession
    given = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    current, _ = stages.stage_at(
        given.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    loops = current.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    links, path = current.where("a <> b"), None
    seen = _summary(links)
    while seen[0]:
        small = seen[0] <= BROADCAST_EDGES
        links, new_path = stages.stage_at(_small_star(_large_star(links, small), small).distinct(), "stars")
        if path:
            stages.discard(spark, path)
        path, before = new_path, seen
        seen = _summary(links)
        if seen == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.distinct())
    return found.union(loops.join(found, "node", "left_anti"))
