"""Hierarchical communities: hierarchy tables, ranks, sizes, contents and text.

Detection is in :mod:`leiden`. Membership is the long table ``(entity, level, community)``, one row per entity and level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.leiden import detect_communities, modularity  # noqa: F401

REPORT_LEVELS = (0, 1, 4)


# --- hierarchy --------------------------------------------------------------------------------------------------


def community_id(level: Column, community: Column) -> Column:
    """``<level>-<community>``."""
    return F.concat_ws("-", level.cast("string"), community.cast("string"))


def _identified(membership: DataFrame) -> DataFrame:
    return membership.select("entity", "level", community_id(F.col("level"), F.col("community")).alias("community"))


def community_nodes(membership: DataFrame) -> DataFrame:
    """``(id, level)``, one row per community."""
    return _identified(membership).select(F.col("community").alias("id"), "level").distinct()


def community_edges(membership: DataFrame) -> DataFrame:
    """``(child, parent, child_level)``: entities into level 0 (child level -1), communities into the level above."""
    named = _identified(membership)
    entities = named.where(F.col("level") == 0).select(
        F.col("entity").cast("string").alias("child"), F.col("community").alias("parent"), F.lit(-1).alias("child_level")
    )
    above = named.select("entity", (F.col("level") - 1).alias("level"), F.col("community").alias("parent"))
    nested = named.join(above, ["entity", "level"]).select(
        F.col("community").alias("child"), "parent", F.col("level").alias("child_level")
    )
    return entities.union(nested).distinct()


def community_rank(membership: DataFrame, mentions: DataFrame) -> DataFrame:
    """``(community, community_rank)``: distinct documents mentioning any entity of the community.

    A community without documents has no row. Documents are made distinct per community before they are counted, so
    that a community holding most entities is counted by all tasks.
    """
    found = _identified(membership).join(mentions, F.col("entity") == F.col("entity_id"))
    return (
        found.select("community", "doc_id").distinct().groupBy("community")
        .agg(F.count(F.lit(1)).alias("community_rank"))
    )


def community_size(membership: DataFrame) -> DataFrame:
    """``(community, level, entities)``; the level is the text before the first dash of the id."""
    sizes = _identified(membership).distinct().groupBy("community").agg(F.count(F.lit(1)).alias("entities"))
    return sizes.select("community", F.split_part("community", F.lit("-"), F.lit(1)).alias("level"), "entities")


def community_percentiles(sizes: DataFrame) -> DataFrame:
    """Per level: number of communities, interpolated size percentiles and the largest size."""
    points = (0.25, 0.5, 0.75, 0.9, 0.99)
    stats = sizes.groupBy("level").agg(
        F.count(F.lit(1)).alias("communities"),
        F.percentile("entities", F.array(*[F.lit(p) for p in points])).alias("_p"),
        F.max("entities").alias("max"),
    )
    return stats.select(
        "level", "communities", *[F.col("_p")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(points)], "max"
    )


# --- contents ---------------------------------------------------------------------------------------------------


def entity_type(labels: Column, base: str = "__Entity__") -> Column:
    """First label that is not the base label; null when there is none."""
    return F.try_element_at(F.filter(labels, lambda l: l != base), F.lit(1))


def _reported(membership: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Membership at the wanted levels, of communities with more than one entity."""
    wanted = _identified(membership.where(F.col("level").isin(*levels)))
    large = wanted.groupBy("community").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return wanted.join(large.select("community"), "community", "left_semi")


def community_nodes_of(membership: DataFrame, entities: DataFrame, levels: tuple[int, ...] = REPORT_LEVELS) -> DataFrame:
    """``(community, id, description, type)``, one row per member entity."""
    return (
        _reported(membership, levels)
        .join(entities, F.col("entity") == F.col("id"))
        .select("community", "id", "description", "type")
    )


def community_rels_of(membership: DataFrame, edges: DataFrame, levels: tuple[int, ...] = REPORT_LEVELS) -> DataFrame:
    """``(community, start, type, end, description)``: relationships with both ends in the community.

    Each edge meets its source's memberships, then its target's on entity and community together, so both joins stay
    at one row per edge and level.
    """
    inside = _reported(membership, levels)
    heads = inside.select(F.col("entity").alias("src"), "community")
    tails = inside.select(F.col("entity").alias("dst"), "community")
    return edges.join(heads, "src").join(tails, ["dst", "community"]).select(
        "community", F.col("src").alias("start"), "type", F.col("dst").alias("end"), "description"
    )


def _described(line: Column) -> Column:
    """The line plus its description, when there is one."""
    told = F.col("description").isNotNull() & (F.col("description") != "")
    return F.concat(line, F.when(told, F.concat(F.lit(", description: "), F.col("description"))).otherwise(F.lit("")))


# The formats of report lines and headings below.


def node_line() -> Column:
    return _described(F.concat(F.lit("id: "), F.col("id"), F.lit(", type: "), F.coalesce("type", F.lit("None"))))


def rel_line() -> Column:
    return _described(
        F.concat(F.lit("("), F.col("start"), F.lit(")-[:"), F.col("type"), F.lit("]->("), F.col("end"), F.lit(")"))
    )


def community_lines(nodes: DataFrame, rels: DataFrame) -> DataFrame:
    """``(community, section, line, copies)``: the report lines of each community as rows, nodes (0) before relations (1)."""
    lines = nodes.select("community", F.lit(0).alias("section"), node_line().alias("line")).union(
        rels.select("community", F.lit(1).alias("section"), rel_line().alias("line"))
    )
    return lines.groupBy("community", "section", "line").agg(F.count(F.lit(1)).alias("copies"))


def community_text(nodes: DataFrame, rels: DataFrame, parts: int = 1) -> DataFrame:
    """``(community, part, text)``: the report block of each community, lines in alphabetical order.

    One part holds a whole community, and a row then grows with it; :func:`community_lines` has no such row. With more
    parts every community, whatever its size, is spread over them by line hash, each a block of its own.
    """
    counted = community_lines(nodes, rels)
    digest = F.md5(F.concat_ws("|", F.col("section").cast("string"), F.col("line")))
    placed = counted.withColumn("part", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(parts))
    rendered = placed.withColumn("_text", F.expr("repeat(concat(line, '\n'), cast(copies as int))"))
    blocks = rendered.groupBy("community", "part").agg(
        F.array_sort(F.collect_list(F.struct("section", "line", "_text"))).alias("rows")
    )

    def section(number: int) -> Column:
        chosen = F.filter("rows", lambda r: r["section"] == number)
        return F.array_join(F.transform(chosen, lambda r: r["_text"]), "")

    text = F.concat(
        F.lit("Nodes are:\n"), section(0), F.lit("\n"), F.lit("Relationships are:\n"), section(1)
    )
    return blocks.select("community", "part", text.alias("text"))
