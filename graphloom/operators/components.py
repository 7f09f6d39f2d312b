"""Weakly connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest member of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m"))
    lowest = lowest.select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges point from larger to smaller."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node is either a root or a child of exactly one root."""
    roles = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("root"))
    )
    per_node = roles.groupBy("id").agg(F.sum("child").alias("children"), F.max("root").alias("root"))
    broken = per_node.where((F.col("children") > 1) | ((F.col("children") > 0) & (F.col("root") > 0)))
    return broken.limit(1).count() == 0


def connected_components(
    edges: DataFrame, nodes: DataFrame | None = None, src: str = "src", dst: str = "dst", node: str = "id"
) -> DataFrame:
    """``(id, component)`` with the smallest member as the component's id.

    Nodes without edges are their own component when ``nodes`` is given. Each round is a written table, and the driver
    only learns whether the rounds are done. A hub's rows are pre-aggregated to its minimum before they meet it, and
    the hub side of the join is one row, which adaptive skew handling can copy to every split.
    """
    current = (
        edges.where(F.col(src) != F.col(dst))
        .select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .distinct()
    )
    current = materialize(current)
    while not _is_forest_of_stars(current):
        current = materialize(_small_star(_large_star(current)))
    found = current.select(F.col("u").alias(node), F.col("v").alias("component")).union(
        current.select("v", "v").distinct()
    )
    if nodes is None:
        loops = edges.where(F.col(src) == F.col(dst)).select(F.col(src).alias(node)).distinct()
        lonely = loops.join(found, node, "left_anti")
        return found.union(lonely.select(node, F.col(node).alias("component")))
    return nodes.select(node).distinct().join(found, node, "left").select(
        node, F.coalesce("component", node).alias("component")
    )


def component_changes(stored: DataFrame, links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(id, component)`` of the nodes that new links add or move, to be written over the stored ``(id, component)``.

    Links are contracted to links between stored components, so the rounds work on a graph of at most the new links,
    whatever the size of the stored one; of that only components that lose their name are read out. Stored names are
    smallest members, and so are the new ones. Links with a null end say nothing; a loop adds its node. No links, no changes.
    """
    known = links.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    ends = known.select(F.col("src").alias("id")).union(known.select("dst")).distinct()
    named = stored.select("id", "component").join(ends, "id", "left_semi").distinct()
    named = materialize(ends.join(named, "id", "left").select("id", F.coalesce("component", "id").alias("label"), F.col("component").isNull().alias("fresh")))
    heads = named.select(F.col("id").alias("src"), F.col("label").alias("a"))
    tails = named.select(F.col("id").alias("dst"), F.col("label").alias("b"))
    contracted = known.join(heads, "src").join(tails, "dst").select("a", "b")
    names = named.select(F.col("label").alias("id"))
    merged = materialize(connected_components(materialize(contracted), names, "a", "b").select(F.col("id").alias("label"), F.col("component").alias("name")))
    fresh = named.where("fresh").join(merged, "label").select("id", F.col("name").alias("component"))
    lost = merged.where("label <> name")
    moved = stored.select("id", F.col("component").alias("label")).join(lost, "label").select("id", F.col("name").alias("component"))
    return moved.unionByName(fresh)


def updated_components(stored: DataFrame, links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The stored ``(id, component)`` with the changes that new links make."""
    changes = materialize(component_changes(stored, links, src, dst))
    return stored.select("id", "component").join(changes, "id", "left_anti").unionByName(changes)


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def component_stats(components: DataFrame) -> DataFrame:
    """Component count and the distribution of sizes, one row."""
    points = F.percentile("size", F.array(*[F.lit(p) for p in (0.5, 0.75, 0.9, 0.95, 0.99)]))
    stats = component_sizes(components).agg(
        F.count(F.lit(1)).alias("component_count"),
        F.min("size").alias("min_size"),
        F.avg("size").alias("mean_size"),
        points.alias("p"),
        F.max("size").alias("max_size"),
    )
    return stats.select(
        "component_count",
        "min_size",
        "mean_size",
        *[F.col("p")[i].alias(name) for i, name in enumerate(("p50", "p75", "p90", "p95", "p99"))],
        "max_size",
    )
